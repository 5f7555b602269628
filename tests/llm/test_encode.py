from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import encode

pytestmark = pytest.mark.skipif(not os.path.exists(encode.VOCABULARY), reason="the public vocabulary isn't here")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(encode.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


LONG = ["a" * 5000, "ab" * 3000, " " * 3000, "=-" * 2000, "é" * 900, "中" * 900, "".join(random.Random(1).choice("etaoin") for _ in range(9000)), "<|endoftext|> x", "\r\n\t x", "​ "]


@pytest.mark.parametrize("text", LONG)
def test_long_and_odd_texts(library, text):
    t = encode.transducer()
    ids = t.encode(text)
    assert ids == library(text)
    assert encode.Decoder(t.ranks).decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60))
def test_any_text(text):
    t = encode.transducer()
    from tokenizers import Tokenizer

    global _lib
    try:
        lib = _lib
    except NameError:
        lib = Tokenizer.from_file(encode.VOCABULARY.replace(".tiktoken", ".json"))
        lib.encode_special_tokens = True
        globals()["_lib"] = lib
    assert t.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_memory_stays_constant():
    t = encode.transducer()
    seen = []
    real = t.settle

    def settle(buf, base, last, e):
        out = list(real(buf, base, last, e))
        seen.append((len(buf), len(last)))
        return iter(out)

    t.settle = settle
    try:
        list(t.stream(b"abcdefghij" * 5000))
    finally:
        del t.settle
    assert max(a for a, _ in seen) <= 8 * t.longest and max(b for _, b in seen) <= 8 * t.longest + 1


def test_column(spark):
    d = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " ", 0), (3, " ", 0), (4, "Hello", 0)], "doc_id long, text string, ids int")
    got = sorted((r.doc_id, r.ids) for r in encode.encode_column(d, "doc_id", "text").collect())
    assert got[:2] == [(1, []), (2, [])] and got[2] == got[3] == (3, [220]) and got[4][1] == [15496]
    assert encode.encode_column(d.limit(0), "doc_id", "text").count() == 0


def test_whole_table(spark, tiny, library):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in encode.p7_ids(spark, tiny).collect()}
    assert got == {k: library(v) if v else [] for k, v in text.items()}
