from __future__ import annotations

from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tessella.llm import rank


def test_inverse_normal(spark):
    ps = [1e-9, 1e-4, 0.01, 0.2, 0.5, 0.7, 0.975, 0.9999]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(rank.inverse_normal(F.col("p"))).collect()]
    assert got == pytest.approx([NormalDist().inv_cdf(p) for p in ps], abs=1e-6)


def test_percentiles_over_many_partitions(spark):
    import random

    r = random.Random(3)
    data = [("hot" if r.random() < 0.8 else "b", float(r.randint(0, 30))) for _ in range(3000)] + [("one", 5.0), ("hot", None), ("hot", float("nan"))]
    got = {(x.g, x.v): x.p for x in rank.percentiles(spark.createDataFrame(data, "g string, v double"), ["g"], "v").collect()}
    for g in ("hot", "b", "one"):
        vs = [v for a, v in data if a == g and v is not None and v == v]
        for v in set(vs):
            assert got[g, v] == pytest.approx((sum(x < v for x in vs) + sum(x == v for x in vs) / 2) / len(vs))
    assert len(got) == len({(g, v) for g, v in data if v is not None and v == v})


def test_no_score_wins_by_its_range(spark):
    rows = [("q", "good", 3.0, 0.9, "t"), ("q", "wide", 9e9, 0.1, "t"), ("q", "a", 2.0, 0.5, "t"), ("q", "b", 1.0, 0.6, "t"), ("q", "none", None, None, None), ("q", "good", 3.0, 0.9, "t")]
    d = spark.createDataFrame(rows, "query_id string, id string, x double, y double, kind string")
    got = {r.id: r.combined for r in rank.combine(d, "query_id", ["id"], {"x": (1.0, True), "y": (1.0, True)}).collect()}
    assert max((v, k) for k, v in got.items() if v is not None)[1] == "good" and got["none"] is None and len(got) == 5
    lower = rank.combine(d, "query_id", ["id"], {"y": (1.0, False)}).collect()
    assert max((r.combined, r.id) for r in lower if r.combined is not None)[1] == "wide"
    assert rank.combine(d.limit(0), "query_id", ["id"], {"x": (1.0, True)}).count() == 0


def test_level_of_a_kind(spark):
    rows = [("q1", f"a{i}", float(i), "low") for i in range(5)] + [("q1", f"b{i}", 100.0 + i, "high") for i in range(5)]
    d = spark.createDataFrame(rows, "query_id string, id string, x double, kind string")
    got = {r.id: r.combined for r in rank.combine(d, "query_id", ["id"], {"x": (1.0, True)}, {"x": "kind"}).collect()}
    assert got["a4"] == got["b4"] > got["a0"] == got["b0"]
