from __future__ import annotations

import random

import numpy as np
import pytest

from tessella.llm import leaks, visual

SAME = [("café", "cafe\u0301"), ("ﬁrst", "first"), ("ｆｕｌｌ１", "full1"), ("a\u00a0b", "a b"), ("a\u2009 \u2007b", "a b"), ("so\u00adft", "soft"), ("z\u200bw\ufeff", "zw"), ("Ⅱ", "II"), ("℃", "°C"), ("µg", "μg"), ("раyраl", "paypal"), ("е\u0301", "é"), ("e\u00ad\u0301", "é"), ("⾼", "高"), ("不", "不"), ("co‑op", "co-op"), ("a\r\nb", "a b"), ("ɡο", "go")]
DIFFER = [("Case", "case"), ("10⁹", "109"), ("m²", "m2"), ("été", "ete"), ("1", "l"), ("½", "1/2"), ("a b", "ab"), ("x", "y")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    f = visual.visual_form()
    assert f(a) == f(b) and f(f(a)) == f(a)


@pytest.mark.parametrize(("a", "b"), DIFFER)
def test_differ(a, b):
    f = visual.visual_form()
    assert f(a) != f(b)


def test_mapping_has_no_conflict():
    table = visual.compiled()
    f = visual.visual_form()
    assert len(table) > 5_000 and all(f(to) == to.strip() for to in table.values())


def test_pairs(spark):
    texts = [(1, "heart failure"), (2, "heart\u00a0failure"), (3, "heart failure"), (4, None), (5, " "), (6, "\u200b"), (7, "Heart failure"), (8, "other"), (9, "other")]
    d = spark.createDataFrame([(i, t, "r") for i, t in texts], "doc_id long, text string, reads string")
    got = visual.pairs_reading_alike(visual.reading_keys(d, "doc_id", "text"))
    assert sorted(map(tuple, got.collect())) == [(1, 2), (2, 3)]
    assert visual.pairs_reading_alike(visual.reading_keys(d.limit(0), "doc_id", "text")).count() == 0


def test_one_hot_reading(spark):
    """Many exact copies and a few odd codings: each copy with each odd one, and the odd ones among themselves."""
    d = spark.range(5000).selectExpr("id doc_id", "CASE id % 1000 WHEN 0 THEN concat('a\\u00a0b', repeat('\\u200b', int(id / 1000))) ELSE 'a b' END text")
    got = visual.pairs_reading_alike(visual.reading_keys(d, "doc_id", "text"))
    assert got.count() == got.distinct().count() == 4995 * 5 + 10 and got.filter("doc_id_a >= doc_id_b").isEmpty()


W = [f"w{i}" for i in range(30)]


def items(spark):
    return spark.createDataFrame([(1, "en", " ".join(W[:20])), (2, "zh", "".join(chr(0x4E00 + 7 * i) for i in range(40))), (3, "en", "two words"), (4, "en", None), (1, "en", " ".join(W[:20]))], "item_id long, lang string, text string")


def test_leaks(spark):
    zh = "".join(chr(0x4E00 + 7 * i) for i in range(40))
    docs = [(1, "x " + " ".join(W[3:15]) + " y"), (2, " ".join(W[3:14]) + " z"), (3, "Say: " + ", ".join(w.upper() for w in W[4:18])), (4, "前" + zh[3:27] + "后"), (5, zh[3:26]), (6, None), (7, ""), (8, "here are two\nwords."), (9, "，".join(zh[0:24])), (10, "filler " * 20000 + " ".join(W[:12]))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    want = [(1, 1), (3, 1), (4, 2), (8, 3), (9, 2), (10, 1)]
    assert sorted(map(tuple, leaks.leaks(d, items(spark)).collect())) == want
    assert sorted(map(tuple, leaks.leaks(d, items(spark), held=60).collect())) == want  # by a join
    assert leaks.leaks(d, items(spark).limit(0)).count() == 0 and leaks.leaks(d.limit(0), items(spark)).count() == 0


@pytest.mark.parametrize("held", [leaks.HELD, 10])
def test_leaks_with_an_edit(spark, held):
    changed = W[:12]
    changed[5] = "other"
    d = spark.createDataFrame([(1, " ".join(changed)), (2, "not at all " * 9)], "doc_id long, text string")
    assert sorted(map(tuple, leaks.leaks(d, items(spark).filter("item_id = 1"), max_edits=1, held=held).collect())) == [(1, 1)]


@pytest.mark.parametrize(("edits", "length"), [(1, 12), (2, 12), (3, 12), (1, 24), (2, 24), (3, 24)])
def test_recall_of_edited_windows(edits, length):
    """Measured: of windows with random edits, how many share a key with the window that they were made from."""
    places, samples = leaks.samples_for(0.95, edits, length)
    keys, r = leaks.Keys(length, places, samples), random.Random(edits * length)
    hits = 0
    for _ in range(200):
        a = [r.getrandbits(64) for _ in range(length + edits + 1)]
        b = list(a)
        for _ in range(edits):
            at, how = r.randrange(length), r.randrange(3)
            b[at : at + (how != 1)] = [r.getrandbits(64)] if how != 2 else []
        hits += bool((keys(np.array(a, np.uint64), np.array([0])) == keys(np.array(b, np.uint64), np.array([0]))).any())
    assert hits >= 184


def test_an_unreachable_recall_is_an_error():
    with pytest.raises(ValueError):
        leaks.samples_for(0.999999, 60, 12)
    assert leaks.samples_for(0.99, 0, 12) == (leaks.PLACES, 1)


def test_leaks_equal_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()
    its = spark.read.parquet(f"{tiny}/eval_items.parquet").collect()
    want = set()
    for item in its:
        chars, n = item.lang == "zh", leaks.CHARS if item.lang == "zh" else leaks.WORDS
        sep = "" if chars else " "
        u = leaks.units(item.text, chars, visual.visual_form())
        grams = {sep + sep.join(u[i : i + n]) + sep for i in range(len(u) - n + 1)}
        for d in docs:
            if d.text:
                whole = sep + sep.join(leaks.units(d.text, chars, visual.visual_form())) + sep
                if any(g in whole for g in grams):
                    want.add((d.doc_id, item.item_id))
    assert set(map(tuple, leaks.p8_found(spark, tiny).collect())) == want
