"""Incremental ingest as a stream: new files of a folder, each batch joined against what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessella.sources.ingest import KEYS, fresh
from tessella.sources.store import commit, stored, tables, write_part


def new_rows(spark: SparkSession, folder: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(folder)


def append_new(stream: DataFrame, folder: str, name: str, checkpoint: str, keys: Sequence[str] | None = None) -> StreamingQuery:
    """Appends rows to a table of a folder whose key, the table's own unless it is given, isn't stored. A batch that is given again after a
    failure appends nothing twice."""
    by = list(keys or KEYS[name])

    def each(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        old = tables(spark, folder)
        part = write_part(fresh(batch, by, stored(spark, folder, name)), folder, name)
        commit(spark, folder, {**old, name: [*old.get(name, []), part]})

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
