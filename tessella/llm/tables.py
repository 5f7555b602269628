"""Reading the tables for this subpackage's queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.tables import spread, table


def texts(spark: SparkSession, folder: str, *, documents: str | None = None, sections: str | None = None, chunks: str | None = None) -> DataFrame:
    """(item_kind, item_key, content) of the named text columns."""
    parts = []
    if documents:
        parts.append(table(spark, folder, "documents").select(F.lit("document").alias("item_kind"), F.col("doc_id").cast("string").alias("item_key"), F.col(documents).alias("content")))
    if sections:
        parts.append(table(spark, folder, "sections").select(F.lit("section").alias("item_kind"), F.col("section_id").cast("string").alias("item_key"), F.col(sections).alias("content")))
    if chunks:
        parts.append(table(spark, folder, "chunks").select(F.lit("chunk").alias("item_kind"), F.col("chunk_id").alias("item_key"), F.col(chunks).alias("content")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return spread(out)
