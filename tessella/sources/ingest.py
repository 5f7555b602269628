"""Rows of the stored tables, and their refresh, whole or by what is new; changes of all tables show at once (see store)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.records import department_text, truthy, year
from tessella.functions.text import retrieval_text, token_count
from tessella.operators.aggregates import duplicate_keys
from tessella.operators.search import check_dimension
from tessella.sources.store import commit, stored, tables as parts_of, write_part

#: What a row of each table is known by.
KEYS = {"documents": ["doc_id"], "document_cards": ["doc_id"], "document_views": ["view_id"], "sections": ["doc_id", "section_index"], "chunks": ["chunk_id"], "embeddings": ["id", "model"]}


def _text(c: str, default: str = ""):
    return F.coalesce(F.col(c), F.lit(default))


def document_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", _text("title").alias("title"), _text("abstract").alias("abstract"), F.coalesce(F.nullif(F.col("publication_date"), F.lit("")), F.lit("unknown")).alias("publication_date"),
        year("publication_date").alias("publication_year"), _text("source_institution", "Unknown").alias("source_institution"), department_text("clinical_department").alias("clinical_department"),
        F.coalesce(F.nullif(F.lower(F.trim("document_kind")), F.lit("")), F.lit("guideline")).alias("document_kind"), _text("source_file").alias("source_file"), _text("markdown_clean_path").alias("markdown_clean_path"), _text("content_md").alias("content_md"),
    )


def card_rows(df: DataFrame) -> DataFrame:
    flags = ("source_pdf_needs_ocr", "source_pdf_is_scanned", "pdf_needs_ocr", "pdf_is_scanned", "ocr_applied")
    return df.select("doc_id", _text("title").alias("title"), year("publication_date").alias("publication_year"), *[truthy(f).alias(f) for f in flags], _text("card_text").alias("card_text"), F.coalesce(F.to_json("fields"), F.lit("{}")).alias("fields_json"))


def view_rows(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.nullif(F.col("view_id"), F.lit("")), F.concat_ws("__", "doc_id", "view_type")).alias("view_id"), "doc_id", "view_type", F.coalesce(F.nullif(F.col("priority"), F.lit(0.0)), F.lit(1.0)).alias("priority"), _text("text").alias("text"))


def section_rows(df: DataFrame) -> DataFrame:
    return df.select(F.xxhash64("doc_id", "section_index").alias("section_id"), "doc_id", "section_index", "section_path", _text("heading").alias("heading"), "char_start", "char_end", _text("content").alias("content"), F.coalesce("is_reference_section", F.lit(False)).alias("is_reference_section"))


def chunk_rows(df: DataFrame) -> DataFrame:
    path = F.coalesce("section_path", F.array().cast("array<string>"))
    own = retrieval_text(_text("title"), path, _text("chunk_type"), _text("content"))
    return df.select("chunk_id", "doc_id", F.array_join(path, " ").alias("section_text"), "chunk_index", _text("content").alias("content"), F.coalesce(F.nullif(F.trim("chunk_type"), F.lit("")), F.lit("other")).alias("chunk_type"),
                     F.coalesce(F.nullif(F.col("token_count"), F.lit(0)), token_count("content")).alias("token_count"), own.alias("retrieval_text"), F.concat_ws("#", F.col("doc_id"), F.col("chunk_index").cast("string")).alias("retrieval_key"))


def latest(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Of rows delivered again the last: an aggregate whose state is one row for a key, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    x = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(at)).alias("__r"))
    return x.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def last_delivery(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The same as `latest` for wide rows: only keys and times are aggregated, and only those of keys that come more than once; a row of
    such a key stays if its time is the last, and rows of all other keys pass without being shuffled. Of equal rows of one time
    one stays. For data that is mostly delivered once: the side that is looked up is as small as the repetitions."""
    n = df.groupBy(*keys).agg(F.max(at).alias("__last"), F.count("*").alias("__n")).filter("__n > 1")
    x = df.join(n.select(*keys, "__last"), list(keys), "left")
    many = x.filter("__last IS NOT NULL").filter(F.col(at) == F.col("__last")).drop("__last").dropDuplicates([*keys])
    return x.filter("__last IS NULL").drop("__last").unionByName(many)


def full_refresh(tables: dict[str, DataFrame], folder: str) -> None:
    """All tables anew; a document that comes twice is an error before anything is written."""
    if (bad := duplicate_keys(tables["documents"], "doc_id").limit(1).collect()):
        raise ValueError(f"document {bad[0]['doc_id']} comes more than once")
    spark = tables["documents"].sparkSession
    commit(spark, folder, {**parts_of(spark, folder), **{name: [write_part(df, folder, name)] for name, df in tables.items()}})


def replace(df: DataFrame, folder: str, name: str) -> None:
    """One table anew; what it is made of may be the table itself."""
    commit(df.sparkSession, folder, {**parts_of(df.sparkSession, folder), name: [write_part(df, folder, name)]})


def fresh(df: DataFrame, keys: Sequence[str], have: DataFrame | None) -> DataFrame:
    """Rows whose key isn't stored, once each."""
    x = df.dropDuplicates(list(keys))
    return x.join(have.select(*keys), list(keys), "left_anti") if have is not None else x


def incremental(tables: dict[str, DataFrame], folder: str, spark: SparkSession) -> dict[str, int]:
    """Appends what belongs to documents that aren't there yet, each row if its own key isn't stored; gives rows appended by table
    and documents skipped. Tables change together in the end, so that a run that breaks off has changed nothing and can be repeated."""
    old = parts_of(spark, folder)
    have = stored(spark, folder, "documents")
    given = tables["documents"].select("doc_id").distinct()
    new = given if have is None else given.join(have.select("doc_id"), "doc_id", "left_anti")
    out = {"skipped_existing_documents": 0}
    parts = dict(old)
    for name, df in tables.items():
        rows = fresh(df.join(new, "doc_id", "left_semi"), KEYS[name], stored(spark, folder, name))
        part = write_part(rows, folder, name)
        parts[name] = [*old.get(name, []), part]
        out[name] = spark.read.parquet(f"{folder}/{part}").count()
    out["skipped_existing_documents"] = given.count() - out["documents"]
    commit(spark, folder, parts)
    return out


def vector_rows(df: DataFrame, size: int) -> DataFrame:
    """Vectors to be stored: (id, model, dim, embedding), an error where one has another dimension or isn't finite."""
    return check_dimension(df, "embedding", size).select("id", "model", F.lit(size).alias("dim"), "embedding")


def upsert_vectors(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, model) once: the new vector where there is one."""
    return latest(old.withColumn("__o", F.lit(0)).unionByName(new.withColumn("__o", F.lit(1))), ["id", "model"], "__o").drop("__o")


def running_index(df: DataFrame, doc: str, order: str, index: str) -> DataFrame:
    """Missing indexes counted in the order of each document."""
    w = Window.partitionBy(doc).orderBy(order)
    return df.withColumn(index, F.coalesce(F.col(index), F.row_number().over(w) - 1))
