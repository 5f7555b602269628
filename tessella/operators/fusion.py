"""Ranks, their fusion, de-duplication, routing by quota, and fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values.
RRF_K = 60
CANDIDATES, DOCUMENT_CAP, CHUNK_CAP = 50, 20, 30


def ranked(df: DataFrame, id_col: str, channel: str, score: str = "score") -> DataFrame:
    """A channel's top-k with 1-based ranks. The window has no partition: it must only be given a bounded top-k."""
    w = Window.orderBy(F.desc(score), id_col)
    return df.select(F.col(id_col).alias("id"), F.lit(channel).alias("channel"), F.row_number().over(w).alias("rank"))


def rank_within(df: DataFrame, groups: Sequence[str], id_col: str, score: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(score.desc_nulls_last(), F.col(id_col))))


def rrf(ranks: DataFrame, k: int = RRF_K, weights: dict[str, float] | None = None, by: Sequence[str] = (), count: bool = False) -> DataFrame:
    """Reciprocal rank fusion of (by..., id, channel, rank); a channel of weight 0 or less is left out. count: with how many
    channels hold an id."""
    w = F.lit(1.0)
    if weights is not None:
        on = {c: v for c, v in weights.items() if v > 0}
        if not on:
            return ranks.limit(0).select(*by, "id", F.lit(0.0).alias("score"), *([F.lit(0).alias("channels")] if count else []))
        ranks = ranks.filter(F.col("channel").isin(*on))
        w = F.element_at(F.create_map(*[x for c, v in on.items() for x in (F.lit(c), F.lit(float(v)))]), F.col("channel"))
    return ranks.groupBy(*by, "id").agg(F.round(F.sum(w / (F.lit(float(k)) + F.col("rank"))), 9).alias("score"), *([F.count("*").alias("channels")] if count else []))


def last_payload(channels: Sequence[DataFrame], id_col: str) -> DataFrame:
    """Fields of the last channel that has an id, with the ranks of all."""
    both = None
    for i, c in enumerate(channels):
        c = c.withColumn("__order", F.lit(i))
        both = c if both is None else both.unionByName(c, allowMissingColumns=True)
    cols = [c for c in both.columns if c not in (id_col, "__order")]
    return both.groupBy(id_col).agg(*[F.max_by(F.col(c), "__order").alias(c) for c in cols])


def minmax(df: DataFrame, score: str, name: str, by: Sequence[str] = (), equal: str = "sigmoid") -> DataFrame:
    """Scores to 0..1 within a group; where all are equal, the sigmoid of the score, or one. Bounds are aggregated and joined back, so
    that no group is gathered."""
    if by:
        b = df.groupBy(*by).agg(F.min(score).alias("__lo"), F.max(score).alias("__hi"))
        x = df.join(b, list(by))
    else:
        x = df.crossJoin(F.broadcast(df.agg(F.min(score).alias("__lo"), F.max(score).alias("__hi"))))
    s = F.col(score)
    flat = F.lit(1.0) if equal == "one" else F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), s))))
    return x.withColumn(name, F.when(F.col("__hi") > F.col("__lo"), (s - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))).otherwise(flat)).drop("__lo", "__hi")


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; equal keys are combined before the shuffle, so that a hot one isn't gathered."""
    rest = [c for c in df.columns if c not in keys]
    o = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), o).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def unique_documents(hits: DataFrame, k: int, doc: str = "doc_id") -> DataFrame:
    """Of the first 3k hits the best of each document, the first k. hits: doc, score, id."""
    over = hits.orderBy(F.desc("score"), "id").limit(max(3 * k, k))
    return first_per(over, [doc], [-F.col("score"), F.col("id")]).orderBy(F.desc("score"), "id").limit(k)


def sizes(topk: int, pool: int = 50) -> tuple[int, int]:
    """(recall of a channel, candidates for re-ranking)."""
    c = min(4 * topk, CANDIDATES)
    return max(pool, c), c


def quota(df: DataFrame, scope: str, order: Sequence[Column], quotas: dict[str, int], total: int) -> DataFrame:
    """At most a quota of each scope, filled up to the total in the order, in the order. For bounded candidate lists."""
    per = Window.partitionBy(scope).orderBy(*order)
    most = F.coalesce(F.element_at(F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))]), F.col(scope)), F.lit(0))
    x = df.withColumn("__in", (F.row_number().over(per) <= most).cast("int"))
    taken = Window.orderBy(F.desc("__in"), *order)
    return x.withColumn("__pos", F.row_number().over(taken)).filter(F.col("__pos") <= total).drop("__in", "__pos").orderBy(*order)


def fallback(first: DataFrame, second: DataFrame, order: Sequence[Column], wanted: int, id_col: str) -> DataFrame:
    """The first list, then as much of the second as is wanting, marked and numbered. Lazy: the deficit is a column, not a count."""
    w = Window.orderBy(*order)
    a = first.withColumns({"__pos": F.row_number().over(w), "is_fallback": F.lit(False), "fallback_rank": F.lit(None).cast("int")}).filter(F.col("__pos") <= wanted)
    have = a.agg(F.count("*").alias("__have"))
    b = second.join(first.select(id_col), id_col, "left_anti").withColumn("fallback_rank", F.row_number().over(w))
    b = b.crossJoin(F.broadcast(have)).filter(F.col("fallback_rank") <= F.lit(wanted) - F.col("__have")).withColumns({"__pos": F.col("__have") + F.col("fallback_rank"), "is_fallback": F.lit(True)}).drop("__have")
    return a.unionByName(b.select(*a.columns)).orderBy("__pos").drop("__pos")


def boosted(df: DataFrame, type_col: str, boosts: dict[str, float], k: int, id_col: str) -> DataFrame:
    """The first max(5k, 50) by raw score, by score times the boost of their type, the first k. A missing type has 1."""
    m = F.create_map(*[x for t, v in boosts.items() for x in (F.lit(t), F.lit(float(v)))])
    x = df.orderBy(F.desc("score"), id_col).limit(max(5 * k, 50))
    boost = F.when(F.col(type_col).isNull() | (F.col(type_col) == ""), F.lit(1.0)).otherwise(F.coalesce(F.try_element_at(m, F.col(type_col)), F.lit(1.0)))
    return x.withColumn("score", F.round(F.col("score") * boost, 6)).orderBy(F.desc("score"), id_col).limit(k)
