"""Problem 5: one ranking from several differently scaled scores.

Each score becomes its empirical percentile within its group, ties averaged, and by the inverse normal distribution a
normal score; the order is by the weighted mean of a row's normal scores. A score whose level differs between levels
(bm25 between chunk types) is first replaced by its percentile within its level.

Percentiles are found without any window over a whole group: equal values are counted before the shuffle, the counted
values are sorted by range over all partitions, each partition sums its own, and the sums of the partitions before it,
one number for a partition and group, are added. A group of any size is thus spread over as many partitions as its
values need, and a value held by a third of all rows is one counted row. The join back is a plain equi-join whose hot
keys adaptive execution splits.

Defined results: a null or NaN score neither counts nor weighs; a row without any score comes last; a group of one has the
median. Equal rows are one. Ties in the mean are ordered by the id. Infinite scores rank as the extremes they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.session import cut
from tessella.sources.tables import table

#: The public rational approximation AS241 (PPND7) of the inverse normal distribution.
A = (3.3871327179, 50.434271938, 159.29113202, 59.109374720)
B = (1.0, 17.895169469, 78.757757664, 67.187563600)
C = (1.4234372777, 2.7568153900, 1.3067284816, 0.17023821103)
D = (1.0, 0.73700164250, 0.12021132975)
E = (6.6579051150, 3.0812263860, 0.42868294337, 0.017337203997)
F_ = (1.0, 0.24197894225, 0.012258202635)


def _poly(x: Column, c: Sequence[float]) -> Column:
    out = F.lit(c[-1])
    for k in reversed(c[:-1]):
        out = out * x + F.lit(k)
    return out


def inverse_normal(p: Column) -> Column:
    """Of 0 < p < 1, in the JVM."""
    q = p - F.lit(0.5)
    s = F.lit(0.180625) - q * q
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    t, u = r - F.lit(1.6), r - F.lit(5.0)
    tail = F.when(r <= 5.0, _poly(t, C) / _poly(t, D)).otherwise(_poly(u, E) / _poly(u, F_))
    return F.when(F.abs(q) <= 0.425, q * _poly(s, A) / _poly(s, B)).otherwise(F.signum(q) * tail)


def percentiles(long: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, value, p): for each distinct value of each group the share of rows below it plus half of those at it."""
    g = list(group)
    counted = long.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*g, value).agg(F.count("*").alias("n"))
    parts = max(1, int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # range bounds come from a sample: cut, so that both uses below see one partitioning
    ranged = cut(counted.repartitionByRange(parts, *g, value).withColumn("part", F.spark_partition_id()))
    own = Window.partitionBy("part", *g).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("part", *g).agg(F.sum("n").alias("in_part"))
    # a row for a partition and group: as many as distinct groups plus partitions
    over = Window.partitionBy(*g)
    before = sums.withColumns({"total": F.sum("in_part").over(over), "before": F.coalesce(F.sum("in_part").over(over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    below = F.coalesce(F.sum("n").over(own), F.lit(0))
    return ranged.withColumn("below", below).join(before, ["part", *g]).select(*g, value, ((F.col("before") + F.col("below") + F.col("n") / 2.0) / F.col("total")).alias("p"))


def combine(rows: DataFrame, group: str, row_id: Sequence[str], scores: dict[str, tuple[float, bool]], levels: dict[str, str] | None = None) -> DataFrame:
    """rows with `combined`, the weighted mean of normal scores. scores: column -> (weight, whether higher is better). levels:
    column -> the column whose values differ in its level."""
    ids = list(dict.fromkeys([*row_id, group]))
    levels = levels or {}
    rows = rows.dropDuplicates(ids)

    def long(names: Sequence[str], by: dict[str, str], frame: DataFrame) -> DataFrame:
        one = [F.struct(F.lit(s).alias("score"), F.col(by.get(s, group)).cast("string").alias("of"), (F.col(s) * (1.0 if scores[s][1] else -1.0)).alias("value")) for s in names]
        return frame.select(*ids, F.explode(F.array(*one)).alias("x")).select(*ids, "x.*").filter(F.col("value").isNotNull() & ~F.isnan("value"))

    flat = [s for s in scores if s not in levels]
    parts = [long(flat, {}, rows)] if flat else []
    for s, level in levels.items():
        in_level = long([s], {s: level}, rows.withColumn(level, F.coalesce(F.col(level), F.lit(""))))
        p = percentiles(in_level, ["score", "of"], "value")
        parts.append(in_level.join(p, ["score", "of", "value"]).select(*ids, "score", F.col(group).cast("string").alias("of"), F.col("p").alias("value")))
    both = parts[0]
    for x in parts[1:]:
        both = both.unionByName(x)
    p = percentiles(both, ["score", "of"], "value")
    weight = F.element_at(F.create_map(*[x for s, (w, _) in scores.items() for x in (F.lit(s), F.lit(float(w)))]), F.col("score"))
    # rounded: the order must not hang on the order in which floats are added
    mean = both.join(p, ["score", "of", "value"]).withColumn("w", weight).groupBy(*ids).agg((F.round(F.sum(inverse_normal(F.col("p")) * F.col("w")) / F.sum("w"), 9) + F.lit(0.0)).alias("combined"))
    return rows.join(mean, ids, "left")


SCORES = {"bm25_score": (1.0, True), "dense_distance": (1.0, False), "text_rank": (1.0, True), "rerank_logit": (1.0, True), "priority": (1.0, True)}


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Each query's candidates with their chunk's type and their view's priority; of rows delivered again, the last."""
    r = table(spark, folder, "rank_candidates", "query_id", "chunk_id", "view_id", "bm25_score", "dense_distance", "text_rank", "rerank_logit", "retrieved_at")
    r = r.groupBy("query_id", "chunk_id", "view_id").agg(*[F.max_by(c, "retrieved_at").alias(c) for c in ("bm25_score", "dense_distance", "text_rank", "rerank_logit")])
    c = table(spark, folder, "chunks", "chunk_id", "chunk_type", "ingested_at").groupBy("chunk_id").agg(F.max_by(F.lower(F.trim("chunk_type")), "ingested_at").alias("chunk_type"))
    v = table(spark, folder, "document_views", "view_id", "priority", "ingested_at").groupBy("view_id").agg(F.max_by("priority", "ingested_at").alias("priority"))
    return r.join(c, "chunk_id", "left").join(v, "view_id", "left")


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    return combine(cut(candidates(spark, folder)), "query_id", ["query_id", "chunk_id", "view_id"], SCORES, {"bm25_score": "chunk_type"})


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The first candidate of each query: an aggregate, not a window, so that a hot query is combined before the shuffle."""
    first = F.max_by("chunk_id", F.struct(F.coalesce("combined", F.lit(float("-inf"))), F.col("chunk_id")))
    return ranked(spark, folder).groupBy("query_id").agg(first.alias("chunk_id"))


def p5_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """Each candidate with its combined score, a weighted mean of normal scores; the order is by it, then the id."""
    return ranked(spark, folder).select("query_id", "chunk_id", "view_id", "combined")


def _sql(tail: str) -> str:
    def poly(x: str, c: Sequence[float]) -> str:
        out = f"{c[-1]!r}::DOUBLE"
        for k in reversed(c[:-1]):
            out = f"(({out}) * {x} + {k!r}::DOUBLE)"
        return out

    z = f"""CASE WHEN abs(p - 0.5) <= 0.425 THEN (p - 0.5) * {poly("(0.180625::DOUBLE - (p - 0.5) * (p - 0.5))", A)} / {poly("(0.180625::DOUBLE - (p - 0.5) * (p - 0.5))", B)}
    ELSE sign(p - 0.5) * CASE WHEN sqrt(-ln(least(p, 1 - p))) <= 5 THEN {poly("(sqrt(-ln(least(p, 1 - p))) - 1.6)", C)} / {poly("(sqrt(-ln(least(p, 1 - p))) - 1.6)", D)}
    ELSE {poly("(sqrt(-ln(least(p, 1 - p))) - 5)", E)} / {poly("(sqrt(-ln(least(p, 1 - p))) - 5)", F_)} END END"""
    return f"""
WITH r AS (SELECT query_id, chunk_id, view_id, max_by(bm25_score, retrieved_at) AS bm25_score, max_by(dense_distance, retrieved_at) AS dense_distance,
    max_by(text_rank, retrieved_at) AS text_rank, max_by(rerank_logit, retrieved_at) AS rerank_logit FROM rank_candidates GROUP BY ALL),
c AS (SELECT chunk_id, max_by(lower(trim(chunk_type)), ingested_at) AS chunk_type FROM chunks GROUP BY chunk_id),
v AS (SELECT view_id, max_by(priority, ingested_at) AS priority FROM document_views GROUP BY view_id),
rows_ AS (SELECT r.*, coalesce(c.chunk_type, '') AS chunk_type, v.priority FROM r LEFT JOIN c USING (chunk_id) LEFT JOIN v USING (view_id)),
b AS (SELECT query_id, chunk_id, view_id, 'bm25_score' AS score,
    (rank() OVER (PARTITION BY chunk_type ORDER BY bm25_score) - 1 + count(*) OVER (PARTITION BY chunk_type, bm25_score) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY chunk_type) AS value
    FROM rows_ WHERE bm25_score IS NOT NULL),
l AS (SELECT * FROM b UNION ALL SELECT query_id, chunk_id, view_id, 'dense_distance', -dense_distance FROM rows_ WHERE dense_distance IS NOT NULL
    UNION ALL SELECT query_id, chunk_id, view_id, 'text_rank', text_rank FROM rows_ WHERE text_rank IS NOT NULL
    UNION ALL SELECT query_id, chunk_id, view_id, 'rerank_logit', rerank_logit FROM rows_ WHERE rerank_logit IS NOT NULL
    UNION ALL SELECT query_id, chunk_id, view_id, 'priority', priority FROM rows_ WHERE priority IS NOT NULL),
p AS (SELECT query_id, chunk_id, view_id, (rank() OVER (PARTITION BY score, query_id ORDER BY value) - 1 + count(*) OVER (PARTITION BY score, query_id, value) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY score, query_id) AS p FROM l),
m AS (SELECT query_id, chunk_id, view_id, round(sum({z}) / count(*), 9) + 0.0::DOUBLE AS combined FROM p GROUP BY ALL)
{tail}"""


P5_FOUND_SQL = _sql("SELECT r.query_id, arg_max(r.chunk_id, (coalesce(combined, '-inf'::DOUBLE), r.chunk_id)) AS chunk_id FROM r LEFT JOIN m USING (query_id, chunk_id, view_id) GROUP BY r.query_id")
P5_RANKED_SQL = _sql("SELECT r.query_id, r.chunk_id, r.view_id, combined FROM r LEFT JOIN m USING (query_id, chunk_id, view_id)")
