"""The registered queries against DuckDB, as the driver compares them."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tessella.plans.queries import QUERIES, SQL


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for p in Path(tiny).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, tiny, duck, name):
    df = QUERIES[name](spark, tiny)
    cols = sorted(df.columns)
    got = Counter(str(tuple(norm(x) for x in r)) for r in df.select(*cols).collect())
    r = duck.execute(SQL[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    assert got == Counter(str(tuple(norm(x[names.index(c)]) for c in cols)) for x in r.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, tiny, name):
    rows = QUERIES[name](spark, tiny).collect()  # all columns of all rows
    assert rows or name in ("repeated_lines",)


@pytest.mark.parametrize("name, source, key, text", [("card_vectors", "document_cards", "doc_id", "card_text"), ("view_vectors", "document_views", "view_id", "text"), ("chunk_vectors", "chunks", "chunk_id", "content")])
def test_a_vector_for_every_row(spark, tiny, duck, name, source, key, text):
    from tessella.functions.records import hash_vector

    got = {r[0]: r.vector for r in QUERIES[name](spark, tiny).collect()}
    last = dict(duck.execute(f"SELECT {key}, arg_max({text}, ingested_at) FROM {source} GROUP BY {key}").fetchall())
    assert got.keys() == last.keys() and len(got) > 0
    for k in sorted(got)[:20]:
        assert list(got[k]) == pytest.approx(list(hash_vector(last[k], 384)), abs=1e-6)


def test_fallback_uses_both_channels(spark, tiny, monkeypatch):
    from tessella.plans import queries

    seen = []
    monkeypatch.setattr(queries, "retrieve_chunks", lambda r, c, s, *, dense=True: seen.append(dense) or c.selectExpr("chunk_id", "1.0D AS score"))
    QUERIES["retrieve_with_fallback"](spark, tiny)
    assert seen == [True, True]


def test_contract(spark):
    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
