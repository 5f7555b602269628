"""JSON lines, Markdown folders with front matter, and binary files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The header's keys in their order.
HEADER = ("id", "title", "publication_date", "source_institution", "source_file", "clinical_department", "clinical_departments", "department_scope", "document_kind", "source_pdf_text_quality", "source_pdf_needs_ocr", "source_pdf_is_scanned", "pdf_page_count", "pdf_text_chars", "pdf_text_chars_per_page", "pdf_low_text_page_ratio", "pdf_image_page_ratio", "pdf_scanned_page_ratio", "pdf_is_scanned", "pdf_needs_ocr", "pdf_text_quality", "ocr_engine", "ocr_applied", "ocr_status", "ocr_error", "cleaning_quality", "cleaning_flags")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines in UTF-8 with or without a byte order mark; blank lines are skipped, a bad line is an error that shows it."""
    raw = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line"), F.col("_metadata.file_path").alias("path")).filter("trim(line) != ''")
    row = F.from_json("line", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}).alias("r")
    x = raw.select(row, "line", "path").select("r.*", "line", "path")
    first = x.columns[0]
    kind = x.schema[first].dataType
    checked = F.when(F.col("__bad").isNotNull(), F.raise_error(F.concat(F.lit("bad JSON line in "), F.col("path"), F.lit(": "), F.substring("line", 1, 80))).cast(kind)).otherwise(F.col(first))
    return x.withColumn(first, checked).drop("__bad", "line", "path")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, "append")


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """(path, markdown) of a folder's *.md."""
    return spark.read.option("wholetext", True).option("pathGlobFilter", "*.md").text(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("markdown"))


def parse_front_matter(markdown: Column) -> Column:
    """struct(header map, body) of `key: "value"` lines between ---; without a closed header the body is the whole text."""
    t = F.regexp_replace(markdown, "\r\n?", "\n")
    header = F.regexp_extract(t, r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)
    has = t.rlike(r"(?s)\A---\n.*?\n---(?:\n|\z)")
    lines = F.filter(F.split(header, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*\s*:"))
    key = lambda x: F.trim(F.substring_index(x, ":", 1))
    value = lambda x: F.replace(F.regexp_replace(F.trim(F.regexp_replace(x, r"^[^:]*:", "")), r'^"(.*)"$', "$1"), F.lit('\\"'), F.lit('"'))
    # of a key that comes twice the last holds
    m = F.aggregate(lines, F.create_map().cast("map<string,string>"), lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, v: k != key(x)), F.create_map(key(x), value(x))))
    return F.struct(F.when(has, m).otherwise(F.create_map().cast("map<string,string>")).alias("header"), F.when(has, F.regexp_replace(t, r"(?s)\A---\n.*?\n---(?:\n|\z)\n?", "")).otherwise(t).alias("body"))


def json_list(value: Column) -> Column:
    """A header's value as a list: a JSON array, or A|B."""
    return F.when(F.trim(value).startswith("["), F.from_json(value, "array<string>")).otherwise(F.filter(F.split(value, r"\|"), lambda x: x != ""))


def dump_front_matter(header: Column, body: Column, keys: Sequence[str] = HEADER) -> Column:
    """The header with every key in its order, then the body."""
    lines = [F.concat(F.lit(f'{k}: "'), F.replace(F.coalesce(F.try_element_at(header, F.lit(k)), F.lit("")), F.lit('"'), F.lit('\\"')), F.lit('"')) for k in keys]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n"), body)


def binary_files(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """(path, length, digest) of files, for de-duplication by content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select("path", "length", F.sha2("content", 256).alias("digest"))


def resolve_path(stored: Column, folder: Column, doc_id: Column) -> Column:
    """A path from another machine falls back to the folder here."""
    foreign = stored.isNull() | stored.rlike(r"^[A-Za-z]:[\\/]") | (stored == "")
    return F.when(foreign, F.concat(folder, F.lit("/"), doc_id, F.lit(".md"))).otherwise(stored)
