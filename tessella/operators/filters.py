"""Optional filters, specialised when the plan is built: a value that isn't given leaves no predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.records import time_bounds


def search_filter(df: DataFrame, *, institution: str | None = None, department: str | None = None, date: str | None = None, kind: str | None = None, time_range: str | dict | None = None) -> DataFrame:
    """Institution and department as patterns (% and _ keep their meaning), kind and date as values, a time range as text bounds:
    `unknown` passes a lower bound and fails an upper one. All reach the scan as pushed filters but the patterns' case."""
    if institution:
        df = df.filter(F.col("source_institution").ilike(f"%{institution}%"))
    if department:
        df = df.filter(F.col("clinical_department").ilike(f"%{department}%"))
    if kind:
        df = df.filter(F.col("document_kind") == kind)
    if date:
        df = df.filter(F.col("publication_date") == date)
    start, end = time_bounds(time_range)
    if start:
        df = df.filter(F.col("publication_date") >= start)
    if end:
        df = df.filter(F.col("publication_date") <= end)
    return df


def without_references(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("is_reference_section"), F.lit(False)))


def metadata_filter(df: DataFrame, wanted: dict[str, object], metadata: str = "metadata") -> DataFrame:
    """None is no restriction, a list is membership, anything else equality; a column first, else the metadata map."""
    for k, v in wanted.items():
        if v is None:
            continue
        actual: Column = F.col(k) if k in df.columns else F.col(metadata)[k]
        df = df.filter(actual.isin(list(v)) if isinstance(v, (list, tuple, set)) else actual == v)
    return df


def read_document(df: DataFrame, *, doc_id: str | None = None, title: str | None = None, max_chars: int = 0) -> DataFrame:
    """By id, or by title: an exact one first, then the latest date, then the shortest title."""
    if not doc_id and not title:
        raise ValueError("doc_id or title is needed")
    if doc_id:
        out = df.filter(F.col("doc_key") == doc_id).orderBy(F.desc("updated_at"), "doc_id").limit(1)
    else:
        exact = F.when(F.lower("title") == title.lower(), 0).otherwise(1)
        out = df.filter((F.lower("title") == title.lower()) | F.col("title").ilike(f"%{title}%")).orderBy(exact, F.desc("publication_date"), F.length("title"), "doc_id").limit(1)
    return out.withColumn("content_md", F.substring("content_md", 1, max_chars)) if max_chars > 0 else out


def indexed(df: DataFrame) -> DataFrame:
    """The projection that an index needs: text falls back where its embedding text is empty."""
    return df.withColumn("text_for_embedding", F.coalesce(F.nullif(F.col("text_for_embedding"), F.lit("")), F.col("text"), F.lit("")))


def as_results(df: DataFrame, channel: str) -> DataFrame:
    return df.withColumns({"score": F.coalesce(F.col("score").cast("double"), F.lit(0.0)), "channel": F.lit(channel)})
