from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tessella.functions import records as R
from tessella.functions import text as X


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


TEXTS = ["", None, "Heart-failure isn't rare: 5 mg/d", "心房颤动 AF 管理", "a　b c d", "１２ x²", "😀 ok", "été"]


@pytest.mark.parametrize("t", TEXTS)
def test_tokens_equal_those_of_python(spark, t):
    want = re.findall(X.TOKEN, (t or "").lower())
    assert one(spark, t, X.tokens) == want
    assert one(spark, t, X.token_count) == len(re.findall(X.TOKEN, t or ""))


@pytest.mark.parametrize("t", TEXTS)
def test_squeeze_knows_all_space(spark, t):
    assert one(spark, t, X.squeeze) == " ".join((t or "").split())


def test_clip(spark):
    assert one(spark, "abcdef", lambda c: X.clip(c, 3)) == "abc..."
    assert one(spark, "abc", lambda c: X.clip(c, 3)) == "abc"
    assert one(spark, "abc", lambda c: X.clip(c, 0)) == ""


def test_phrase_and_overlap(spark):
    assert one(spark, "Home  monitoring", lambda c: X.contains_phrase(c, "home monitoring"))
    assert not one(spark, None, lambda c: X.contains_phrase(c, "x"))
    assert not one(spark, "x", lambda c: X.contains_phrase(c, ""))
    assert one(spark, "heart and kidney", lambda c: X.term_overlap(c, ["heart", "liver"])) == 0.5
    assert X.query_terms("Heart heart 心衰 x") == ["heart", "心衰", "x"]


def test_flags_and_lines(spark):
    assert one(spark, "a; b,,c ", X.flags) == ["a", "b", "c"]
    assert one(spark, "a,b", lambda c: X.add_flag(c, "b")) == "a,b"
    assert one(spark, ["A", "a", " ", "b", "c"], lambda c: X.dedupe_lines(c, 2), "array<string>") == ["A", "b"]


def test_departments(spark):
    f = one(spark, "A|B||A", R.department_fields)
    assert (f.departments, f.department, f.scope) == (["A", "B"], "A", "compositive")
    assert one(spark, None, R.department_fields).department == "未分类"


def test_dates(spark):
    assert one(spark, "May 2019, 2020", R.year) == 2019
    assert one(spark, "unknown", R.year) is None
    assert one(spark, "2019-02-03", R.valid_date)
    assert not one(spark, None, R.valid_date)
    assert R.time_bounds("2020-05-01~2021-06-30") == ("2020-01-01", "2021-12-31")
    assert R.time_bounds("2020") == ("2020", None)
    assert R.time_bounds(None) == (None, None)
    assert one(spark, "a/2015/b.pdf", lambda c: R.infer_date(c, F.lit("of 2020"))) == "2015-01-01"
    assert one(spark, "a/b.pdf", lambda c: R.infer_date(c, F.lit("in 1999"))) == "unknown"


def test_truth(spark):
    assert [one(spark, v, R.truthy) for v in ("true", " YES", "0", None, "y", "no")] == [True, True, False, False, True, False]


def test_hashing(spark):
    v = one(spark, "heart failure heart", R.hashing_encoder)
    assert v == pytest.approx(R.hash_vector("heart failure heart"))
    assert sum(x * x for x in v) == pytest.approx(1)
    assert not any(one(spark, None, R.hashing_encoder))
    q = R.hash_vector("failure of the heart")
    assert one(spark, "heart failure heart", lambda c: R.hashing_similarity(c, "failure of the heart")) == pytest.approx(sum(a * b for a, b in zip(v, q)))
    assert one(spark, None, lambda c: R.hashing_similarity(c, "x")) == 0.0
    assert one(spark, "Société Générale – 2", lambda c: R.slug(c)) == "societe_generale_2"


def test_vectors(spark):
    r = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>").select(R.normalized(F.col("a")).alias("n"), R.cosine(F.col("a"), F.col("b")).alias("c"), R.vector_literal(F.col("a")).alias("l")).first()
    assert r.n == pytest.approx([0.6, 0.8]) and r.c == 0.0 and r.l == "[3.00000000,4.00000000]"


def test_settings(monkeypatch):
    from tessella.settings import setting

    monkeypatch.setenv("T_A", " Yes ")
    monkeypatch.setenv("T_B", "no number")
    monkeypatch.setenv("T_C", "-2")
    assert setting("T_A", False) is True and setting("T_B", 3) == 3 and setting(("T_B", "T_C"), 3) == -2 and setting("T_C", 1.5, allowed=lambda v: v > 0) == 1.5 and setting("T_NONE", "x") == "x"


def test_small_measures(spark):
    from pyspark.sql import functions as F

    from tessella.functions.text import field_text, readable_ratio
    from tessella.operators.metadata import mean_confidence

    d = spark.createDataFrame([("a1 ，■", "", "c", [0.5, None, 1.0]), (None, "t", "c", []), ("", None, None, None)], "x string, text string, content string, p array<double>")
    got = d.select(F.round(readable_ratio("x"), 4), field_text(d.columns, "text"), mean_confidence(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(0.75, "c", 0.75), (0.0, "t", None), (0.0, "", None)]
