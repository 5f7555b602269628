"""A folder of tables whose contents change at once.

Each table is a list of part folders, and one small file, _TABLES, lists the parts of all tables. A write first brings its parts to
folders that nothing names yet and then swaps the file by a rename, so that a reader sees all of a change or nothing of it, and a
write that breaks off leaves folders that no reader looks at.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

NAME = "_TABLES"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def tables(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The parts of each table; none for a folder that isn't there."""
    p, fs = _path(spark, f"{folder}/{NAME}")
    if not fs.exists(p):
        return {}
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A table as it is now, or None."""
    parts = tables(spark, folder).get(name)
    return spark.read.parquet(*[f"{folder}/{p}" for p in parts]) if parts else None


def write_part(df: DataFrame, folder: str, name: str) -> str:
    """Writes rows to a folder of their own, which belongs to no table before it is committed."""
    part = f"{name}/part-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{part}")
    return part


def commit(spark: SparkSession, folder: str, parts: dict[str, list[str]]) -> None:
    """Makes these the folder's tables: a file beside, renamed over the old one in one step."""
    jvm, new = spark._jvm, f"{folder}/{NAME}-{uuid.uuid4().hex}"
    n, fs = _path(spark, new)
    out = fs.create(n, True)
    out.write(bytearray(json.dumps(parts).encode()))
    out.close()
    o = jvm.org.apache.hadoop.fs.Path(f"{folder}/{NAME}")
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(n.toUri(), spark._jsc.hadoopConfiguration()).rename(n, o, options)


def vacuum(spark: SparkSession, folder: str) -> list[str]:
    """Removes parts that no table names, as broken-off and replaced writes leave them. Not while a write runs."""
    named = {p for ps in tables(spark, folder).values() for p in ps}
    gone = []
    top, fs = _path(spark, folder)
    if not fs.exists(top):
        return gone
    for t in fs.listStatus(top):
        if t.isDirectory():
            for p in fs.listStatus(t.getPath()):
                part = f"{t.getPath().getName()}/{p.getPath().getName()}"
                if p.getPath().getName().startswith("part-") and part not in named:
                    fs.delete(p.getPath(), True)
                    gone.append(part)
    return sorted(gone)
