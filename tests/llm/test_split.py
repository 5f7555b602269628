from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import split

TEXT = st.lists(st.sampled_from(["word", "x-y", "it's", "中", "文。", ". ", "\n\n", "\n- ", " ", "; ", "1.5", "|", "\r\n"]), max_size=400).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(5, 40), st.integers(0, 4))
def test_pieces_are_whole_and_small(text, limit, overlap):
    ps = split.pieces(text, limit, overlap)
    assert "".join(text[f:e] for _, f, e, _ in ps) == text
    tokens = lambda x: len(split._TOKEN.findall(x))
    for s, f, e, n in ps:
        assert n <= limit and tokens(text[s:e]) == n
    for (s, f, e, n), (s2, f2, e2, n2) in zip(ps, ps[1:]):
        assert f2 == e and s2 <= f2 and tokens(text[s2:f2]) == overlap


def test_boundaries_are_natural():
    text = "\n\n".join("One sentence of ten words stands here for a test. " * 3 for _ in range(10))
    for s, f, e, n in split.pieces(text, 100, 10)[:-1]:
        assert text[:e].endswith("\n") or text[:e].rstrip().endswith(".")


def test_the_strongest_cut_wins():
    """A paragraph's end before a later sentence's end, in any piece but the last."""
    text = ("One sentence of seven words stands here. " * 10 + "\n\n") * 6
    assert all(text[:e].endswith("\n\n") for *_, e, _ in split.pieces(text, 120, 10)[:-1])


def test_range_maxima():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 5, 200)
    m = split.Maxima(v)
    for a in range(0, 200, 7):
        for b in range(a, 200, 5):
            want = max(range(a, b + 1), key=lambda i: (v[i], i))
            assert m(a, b) == want


def test_edges(spark):
    assert split.pieces(None) == [] and split.pieces("") == [(0, 0, 0, 0)] and split.pieces("  ") == [(0, 0, 2, 0)]
    assert len(split.pieces("x " * 420)) == 1 and len(split.pieces("x " * 421)) == 2
    assert len(split.pieces("x" * 100_000)) == 1 and len(split.pieces("中" * 5000)) == 14
    with pytest.raises(ValueError):
        split.pieces("x", 10, 10)
    d = spark.createDataFrame([("a", None, 1), ("b", "", 1), ("c", "x " * 500, 1), ("c", "x " * 500, 1)], "k string, content string, piece_index int")
    got = split.split_column(d, "content", "k").collect()
    assert sorted((r.k, r.piece_index) for r in got) == [("b", 0), ("c", 0), ("c", 0), ("c", 1), ("c", 1)]
    assert split.split_column(d, "content", "k", oversized=True).count() == 4
