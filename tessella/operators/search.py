"""Lexical and dense channels over whole tables: BM25, weighted full text, cosine.

A channel scans its table once for statistics of the query's own terms and once for scores, and ends in a top-k that
each task computes before anything is sent. No posting of a term that isn't asked for is ever built or shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.records import cosine, dot
from tessella.functions.text import TOKEN, tokens

K1, B = 1.2, 0.75


def term_frequencies(df: DataFrame, text: Column | str, terms: Sequence[str]) -> DataFrame:
    """df with dl (tokens) and tf (an array, by term)."""
    # each exploded from an array of one: else the optimizer would tokenise, or count, anew for each use
    one = df.withColumn("__tokens", F.explode(F.array(tokens(text))))

    def times(t: str) -> Column:
        return F.size(F.filter("__tokens", lambda x: x == t))

    counted = F.struct(F.size("__tokens").alias("dl"), F.array(*map(times, terms)).alias("tf"))
    x = one.withColumn("__counted", F.explode(F.array(counted)))
    return x.withColumns({"dl": F.col("__counted.dl"), "tf": F.col("__counted.tf")}).drop("__tokens", "__counted")


def delivered_last(df: DataFrame, id_col: str, at: str | None) -> DataFrame:
    """One row for each id, of narrow rows such as scores: of those delivered again the last. Each column is an aggregate of its own, so
    that numbers stay in fixed-width buffers. Texts aren't to be among the columns: they would be shuffled."""
    if at is None:
        return df
    return df.groupBy(id_col).agg(*[F.max_by(c, at).alias(c) for c in df.columns if c not in (id_col, at)])


def bm25(df: DataFrame, query: str, text: Column | str, id_col: str, k: int | None = 50, keep: Sequence[str] = (), only: Column | None = None, at: str | None = None) -> DataFrame:
    """(id, keep..., score, matched). A repeated query token counts again; only scores above 0; by falling score, then id.
    `only` filters what is returned but not the statistics. at: when a row was delivered, where ids come more than once; texts
    become numbers in the scan, and only those are reduced to the last."""
    repeated = Counter(re.findall(TOKEN, (query or "").lower()))
    terms = list(repeated)
    if not terms:
        return df.limit(0).select(id_col, *keep, F.lit(0.0).alias("score"), F.array().cast("array<string>").alias("matched"))
    tf = [f"__tf{i}" for i in range(len(terms))]
    counted = term_frequencies(df, text, terms).select(id_col, *keep, "dl", *[F.col("tf")[i].alias(c) for i, c in enumerate(tf)], *([only.alias("__only")] if only is not None else []), *([at] if at else []))
    counted = delivered_last(counted, id_col, at)
    # one row: as wide as the query
    stats = counted.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *[F.sum((F.col(c) > 0).cast("long")).alias(f"df{c}") for c in tf])
    some = counted.filter(" OR ".join(f"{c} > 0" for c in tf))
    some = some.filter("__only") if only is not None else some
    x = some.crossJoin(F.broadcast(stats))  # a stated one-row aggregate
    dl = F.greatest(F.col("dl"), F.lit(1)).cast("double")
    parts = []
    for c, t in zip(tf, terms):
        d, f = F.col(f"df{c}"), F.col(c).cast("double")
        idf = F.log(F.lit(1.0) + (F.col("n") - d + F.lit(0.5)) / (d + F.lit(0.5)))
        parts.append(F.when(f > 0, F.lit(float(repeated[t])) * idf * (f * F.lit(K1 + 1)) / (f + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * dl / F.greatest(F.col("avgdl"), F.lit(1.0))))).otherwise(F.lit(0.0)))
    score = F.round(sum(parts[1:], parts[0]), 6)
    matched = F.array_sort(F.filter(F.array(*[F.when(F.col(c) > 0, F.lit(t)) for c, t in zip(tf, terms)]), lambda m: m.isNotNull()))
    out = x.select(id_col, *keep, score.alias("score"), matched.alias("matched")).filter("score > 0").orderBy(F.desc("score"), id_col)
    return out.limit(k) if k else out


def payload(top: DataFrame, df: DataFrame, id_col: str, columns: Sequence[str], at: str) -> DataFrame:
    """top with columns of the rows that they are of, read only for its ids. top must be a top-k: it is broadcast."""
    rows = df.select(id_col, at, *columns).join(F.broadcast(top.select(id_col)), id_col, "left_semi")
    last = rows.groupBy(id_col).agg(F.max_by(F.struct(*columns), at).alias("__r"))
    return top.join(last, id_col).select(*top.columns, *[F.col("__r")[c].alias(c) for c in columns])


# -- weighted full text


def parse_query(query: str) -> list[list[tuple[list[str], bool]]]:
    """Alternatives (or) of all-of lists of (words of a phrase, whether it must be absent)."""
    out: list[list[tuple[list[str], bool]]] = [[]]
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', query or ""):
        if word.lower() == "or" and not minus:
            if out[-1]:
                out.append([])
            continue
        ws = re.findall(TOKEN, (phrase or word).lower())
        if ws:
            out[-1].append((ws, bool(minus)))
    return [a for a in out if a]


def _holds(ts: Column, ws: list[str]) -> Column:
    if len(ws) == 1:
        return F.array_contains(ts, ws[0])
    return F.concat(F.lit(" "), F.array_join(ts, " "), F.lit(" ")).contains(" " + " ".join(ws) + " ")


def matches(ts: Column, query: str) -> Column:
    """Whether a row's tokens satisfy the query: all words, phrases in order, no excluded ones, either side of `or`."""
    out = F.lit(False)
    for all_of in parse_query(query):
        one = F.lit(True)
        for ws, absent in all_of:
            one = one & (~_holds(ts, ws) if absent else _holds(ts, ws))
        out = out | one
    return out


#: Weights of the classes A to D.
WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}


def cover_rank(ts: Column, weights: Column, any_of: Sequence[Sequence[str]]) -> Column:
    """Cover density (Clarke, Cormack and Tudhope, 2000) of a row's tokens: each least stretch that holds all words of one of the alternatives
    counts by the harmonic mean of its words' weights, and less by what stands between them. In the JVM, over the few places of the query's words."""
    words = sorted({w for of in any_of for w in of})
    wanted = F.array(*[F.lit(w) for w in words])
    places = F.filter(F.transform(ts, lambda t, i: F.struct(i.alias("p"), F.array_position(wanted, t).alias("k"), F.get(weights, i).alias("w"))), lambda x: x["k"] > 0)

    def of(at: Column) -> Column:
        def end(j: Column) -> Column:
            def first(w: str) -> Column:
                k = words.index(w) + 1
                return F.get(F.filter(F.slice(at, j + 1, F.size(at)), lambda y: y["k"] == k), F.lit(0))["p"]

            each = []
            for of in any_of:
                after = [first(w) for w in of]
                here = sum((a.isNotNull().cast("int") for a in after), F.lit(0)) == len(after)
                each.append(F.when(here, F.greatest(*after) if len(after) > 1 else after[0]))
            return F.least(*each) if len(each) > 1 else each[0]

        ends = F.transform(at, lambda x, j: F.struct(x["p"].alias("q"), end(j).alias("e")))
        # a stretch is the least one unless the next that begins ends where it does
        least = F.filter(F.transform(ends, lambda x, j: F.struct(x["q"].alias("q"), x["e"].alias("e"), F.get(ends, j + 1)["e"].alias("n"))), lambda x: x["e"].isNotNull() & ~x["e"].eqNullSafe(x["n"]))

        def one(acc: Column, x: Column) -> Column:
            inside = F.filter(at, lambda y: (y["p"] >= x["q"]) & (y["p"] <= x["e"]))
            n = F.size(inside).cast("double")
            return acc + n / F.aggregate(inside, F.lit(0.0), lambda a, y: a + F.lit(1.0) / y["w"]) / (F.lit(1.0) + x["e"] - x["q"] + F.lit(1.0) - n)

        return F.aggregate(least, F.lit(0.0), one)

    return F.transform(F.array(places), of)[0]  # bound once by the transform, not made anew for each use


def may_match(texts: Sequence[Column | str], query: str) -> Column:
    """What any matching row satisfies: each wanted word of an alternative is somewhere in its text. Cheap, so that other rows are never
    cut into tokens."""
    low = F.lower(F.concat_ws(" ", *texts))
    out = F.lit(False)
    for all_of in parse_query(query):
        one = F.lit(True)
        for w in {w for ws, absent in all_of if not absent for w in ws}:
            one = one & low.contains(w)
        out = out | one
    return out


def full_text(df: DataFrame, query: str, fields: Sequence[tuple[Column | str, str]], id_col: str, keep: Sequence[str] = (), at: str | None = None) -> DataFrame:
    """(id, keep..., score) of all rows that match the query, ranked over the fields one after another, weighted by their class."""
    words = [sorted({w for ws, absent in a if not absent for w in ws}) for a in parse_query(query)]
    words = [w for w in words if w]
    if not words:
        return df.limit(0).select(id_col, *keep, F.lit(0.0).alias("score"))
    names = [f"__f{i}" for i in range(len(fields))]
    some = df.filter(may_match([c for c, _ in fields], query))
    # exploded from an array of one: made once, not anew for each use
    some = some.withColumn("__each", F.explode(F.array(F.struct(*[tokens(c).alias(n) for n, (c, _) in zip(names, fields)]))))
    rows = some.withColumn("__ts", F.explode(F.array(F.concat(*[F.col(f"__each.{n}") for n in names])))).filter(matches(F.col("__ts"), query))
    weights = F.concat(*[F.array_repeat(F.lit(WEIGHTS[c]), F.size(f"__each.{n}")) for n, (_, c) in zip(names, fields)])
    out = rows.select(id_col, *keep, F.round(cover_rank(F.col("__ts"), weights, words), 6).alias("score"), *([at] if at else []))
    return delivered_last(out, id_col, at)


def cover_density(df: DataFrame, query: str, fields: Sequence[tuple[Column | str, str]], id_col: str, k: int = 50, keep: Sequence[str] = (), at: str | None = None) -> DataFrame:
    return full_text(df, query, fields, id_col, keep, at).orderBy(F.desc("score"), id_col).limit(k)


# -- dense


def scored_topk(df: DataFrame, score: Column, id_col: str, k: int | None = 50, keep: Sequence[str] = ()) -> DataFrame:
    """By a score that is computed in the scan, then the id."""
    out = df.select(id_col, *keep, F.round(score, 6).alias("score")).orderBy(F.desc("score"), id_col)
    return out.limit(k) if k else out


def dense_topk(df: DataFrame, query: Sequence[float], vector: str, id_col: str, k: int | None = 50, keep: Sequence[str] = (), unit: bool = False) -> DataFrame:
    """Exact cosine against all rows; unit vectors need only their product. The query is a literal, so that nothing is joined."""
    q = F.array(*[F.lit(float(x)) for x in query])
    s = dot(F.col(vector), q) if unit else cosine(F.col(vector), q)
    return scored_topk(df.filter(F.size(vector) == len(query)), s, id_col, k, keep)


def cosine_to(vector: str, query: Sequence[float]) -> Column:
    return F.round(cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in query])), 6)


def check_dimension(df: DataFrame, vector: str, size: int) -> DataFrame:
    """Rows with another dimension, a zero or a non-finite vector are an error."""
    bad = (F.size(vector) != size) | F.exists(vector, lambda x: F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))) | ~F.exists(vector, lambda x: x != 0)
    return df.withColumn(vector, F.when(bad, F.raise_error(F.format_string("vector of dimension %d is not usable", F.size(vector))).cast(df.schema[vector].dataType)).otherwise(F.col(vector)))
