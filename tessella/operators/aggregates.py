"""Counts, statistics, checks of a snapshot, de-duplication by content, and metrics of retrieval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.records import year
from tessella.functions.text import squeeze, weak

#: Chunk types that count for type precision.
HIGH_VALUE = ("recommendation", "pico", "evidence", "table", "scope_population", "key_message", "algorithm", "conclusion")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Counts by value, the most frequent first, equal counts by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def kind_counts(df: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    x = df if documents is None else df.join(documents.select("doc_id", "document_kind"), "doc_id")
    return x.groupBy("document_kind").agg(F.count("*").alias("n"))


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """A row for each table: rows and unknown dates; one union, one small aggregate a table."""
    out = None
    for name, df in tables.items():
        unknown = F.count_if(F.col("publication_date") == "unknown") if "publication_date" in df.columns else F.lit(None).cast("long")
        one = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), unknown.alias("unknown_dates"))
        out = one if out is None else out.unionByName(one)
    return out


def snapshot_problems(documents: DataFrame, parts: dict[str, DataFrame], kinds: Sequence[str] = ("guideline", "consensus")) -> DataFrame:
    """(check_name, kind, ok): each kind is there, has as many cards as documents, and at least one of every other part."""
    base = documents.groupBy("document_kind").agg(F.countDistinct("doc_id").alias("documents"))
    x = documents.sparkSession.createDataFrame([(k,) for k in kinds], "document_kind string").join(base, "document_kind", "left")
    keys = documents.select("doc_id", "document_kind").dropDuplicates(["doc_id"])
    for name, df in parts.items():
        c = df.select("doc_id").join(keys, "doc_id").groupBy("document_kind").agg((F.countDistinct("doc_id") if name == "cards" else F.count("*")).alias(name))
        x = x.join(c, "document_kind", "left")
    checks = [F.struct(F.lit("documents").alias("check_name"), (F.coalesce("documents", F.lit(0)) > 0).alias("ok"))]
    for name in parts:
        n = F.coalesce(F.col(name), F.lit(0))
        checks.append(F.struct(F.lit(name).alias("check_name"), (n == F.coalesce("documents", F.lit(0)) if name == "cards" else n > 0).alias("ok")))
    return x.select(F.col("document_kind").alias("kind"), F.explode(F.array(*checks)).alias("c")).select("kind", "c.*")


def vectors_ready(source: DataFrame, vectors: DataFrame, model: str) -> bool:
    """Whether there are as many vectors of the model as rows: two counts."""
    return source.count() == vectors.filter(F.col("model") == model).count()


def duplicates_by_content(df: DataFrame, id_col: str, body: str, order: Sequence) -> DataFrame:
    """(digest, canonical id, id) of all but the canonical row of each content. Only digests and ids are shuffled."""
    x = df.select(id_col, F.sha2(F.coalesce(body, F.lit("")), 256).alias("digest"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(id_col).alias("z")).alias("__o"))
    first = x.groupBy("digest").agg(F.min_by(id_col, "__o").alias("canonical"), F.count("*").alias("n")).filter("n > 1")
    return x.join(first, "digest").filter(F.col(id_col) != F.col("canonical")).select("digest", "canonical", id_col)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def weak_fields(df: DataFrame, id_col: str, limits: dict[str, int]) -> DataFrame:
    """(id, field) of fields that are shorter than their limit."""
    each = F.array(*[F.struct(F.lit(c).alias("field"), weak(c, n).alias("is_weak")) for c, n in limits.items()])
    return df.select(id_col, F.explode(each).alias("w")).filter("w.is_weak").select(id_col, "w.field")


def repair_documents(df: DataFrame, first: int, last: int) -> DataFrame:
    """Squeezed titles, years and digests made anew, dates out of the window dropped; `repaired` says whether a row changed."""
    y = year("publication_date")
    title = squeeze("title")
    return (
        df.filter(y.between(first, last))
        .withColumns({"new_title": title, "new_year": y, "content_sha256": F.sha2(F.coalesce("content_md", F.lit("")), 256)})
        .withColumn("repaired", ~F.col("new_title").eqNullSafe(F.col("title")) | ~F.col("new_year").eqNullSafe(F.col("publication_year")))
    )


def retrieval_metrics(results: DataFrame, relevant: DataFrame, queries: DataFrame, ks: Sequence[int] = (5, 10, 20, 50)) -> DataFrame:
    """One row of means over all queries, those without a relevant item counted as zero. results: query_id, id, doc_id, chunk_type, rank;
    relevant: query_id, id, doc_id; queries: query_id."""
    rel = relevant.select("query_id", "id").distinct().withColumn("hit", F.lit(1))
    docs = relevant.select("query_id", "doc_id").distinct().withColumn("doc_hit", F.lit(1))
    x = results.join(rel, ["query_id", "id"], "left").join(docs, ["query_id", "doc_id"], "left")
    n_rel = rel.groupBy("query_id").agg(F.count("*").alias("n_rel"))
    agg = [F.sum(F.when((F.col("rank") <= k) & (F.col("hit") == 1), 1).otherwise(0)).alias(f"hits_{k}") for k in ks]
    first = F.min(F.when((F.col("rank") <= 10) & (F.col("hit") == 1), F.col("rank"))).alias("first")
    doc = F.max(F.when((F.col("rank") <= 10) & (F.col("doc_hit") == 1), 1).otherwise(0)).alias("doc_10")
    top = F.sum(F.when(F.col("rank") <= 10, 1).otherwise(0)).alias("n_10")
    typed = F.sum(F.when((F.col("rank") <= 10) & F.col("chunk_type").isin(*HIGH_VALUE), 1).otherwise(0)).alias("typed")
    per = queries.select("query_id").join(x.groupBy("query_id").agg(*agg, first, doc, top, typed), "query_id", "left").join(n_rel, "query_id", "left")

    def mean(c) -> object:
        return F.round(F.coalesce(F.avg(F.coalesce(c, F.lit(0.0))), F.lit(0.0)), 6)

    return per.agg(
        *[mean(F.when(F.col("n_rel") > 0, F.col(f"hits_{k}") / F.col("n_rel"))).alias(f"recall_{k}") for k in ks],
        mean(F.lit(1.0) / F.col("first")).alias("mrr_10"), mean(F.col("doc_10").cast("double")).alias("doc_recall_10"),
        mean(F.when(F.col("n_10") > 0, F.col("typed") / F.col("n_10"))).alias("type_precision_10"),
    )
