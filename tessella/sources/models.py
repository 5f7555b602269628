"""Clients of model services, and vectors of rows that have none yet. A service is called from the tasks, a batch of texts at a time."""

from __future__ import annotations

import json
import logging
import math
import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators.joins import missing_vectors

log = logging.getLogger("tessella")
Encoder = Callable[[list[str]], list[list[float]]]


def post_json(url: str, payload: dict, *, key: str | None = None, timeout: float = 120.0, attempts: int = 3, wait: float = 1.0) -> dict:
    """The answer to a JSON request; what fails is tried again, with doubled waits."""
    headers = {"Content-Type": "application/json", **({"Authorization": f"Bearer {key}"} if key else {})}
    request = urllib.request.Request(url, json.dumps(payload).encode(), headers)
    for n in range(attempts):
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return json.load(answer)
        except (OSError, ValueError):
            if n + 1 == attempts:
                raise
            time.sleep(wait * 2**n)
    raise AssertionError


def in_order(items: object, n: int, field: str) -> list:
    """Answers by their index; an error unless there is one for each input."""
    held = {i.get("index"): i.get(field) for i in items if isinstance(i, dict)} if isinstance(items, list) else {}
    if len(held) != n or set(held) != set(range(n)) or any(v is None for v in held.values()):
        raise ValueError(f"the service answered {len(held)} of {n} inputs")
    return [held[i] for i in range(n)]


def unit(vector: list, size: int) -> list[float]:
    """Of length one; an error if it has another dimension, isn't finite, or is zero."""
    v = [float(x) for x in vector]
    n = math.sqrt(sum(x * x for x in v))
    if len(v) != size or not math.isfinite(n) or n == 0.0:
        raise ValueError(f"vector of dimension {len(v)} and length {n} isn't usable")
    return [x / n for x in v]


def service_encoder(url: str, model: str, size: int, **how) -> Encoder:
    def encode(texts: list[str]) -> list[list[float]]:
        if not texts:
            return []
        got = post_json(f"{url.rstrip('/')}/v1/embeddings", {"model": model, "input": texts, "encoding_format": "float", "dimensions": size}, **how)
        return [unit(v, size) for v in in_order(got.get("data"), len(texts), "embedding")]

    return encode


def service_scorer(url: str, model: str, **how) -> Callable[[str, list[str]], list[float]]:
    def score(query: str, texts: list[str]) -> list[float]:
        if not texts:
            return []
        got = post_json(f"{url.rstrip('/')}/v1/rerank", {"model": model, "query": query, "documents": texts, "top_n": len(texts)}, **how)
        out = [float(x) for x in in_order(got.get("results"), len(texts), "relevance_score")]
        if not all(map(math.isfinite, out)):
            raise ValueError("a score isn't finite")
        return out

    return score


def encoded(df: DataFrame, text: str, encode: Encoder, batch: int = 32) -> DataFrame:
    """df with `embedding`; texts go to the encoder in batches."""

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in parts:
            texts = x.fillna("").tolist()
            yield pd.Series([v for a in range(0, len(texts), batch) for v in encode(texts[a : a + batch])], dtype="object")

    return df.withColumn("embedding", run(text))


def vectorised(source: DataFrame, vectors: DataFrame | None, id_col: str, text: str, encode: Encoder, model: str, size: int) -> DataFrame:
    """(id, model, dim, embedding) of the rows that have no vector of the model yet. The whole table is one plan: what a page is, a partition
    is, and a lost one is made again."""
    rows = source.select(F.col(id_col).alias("id"), F.col(text).alias("__text"))
    if vectors is not None:
        rows = missing_vectors(rows, vectors, "id", model)
    return encoded(rows, "__text", encode).select("id", F.lit(model).alias("model"), F.lit(size).alias("dim"), "embedding")


def channel(make: Callable[[], DataFrame], like: DataFrame, required: bool = False) -> DataFrame:
    """A channel that may be wanting: if its plan can't be made, as when its query can't be encoded, it is empty, unless it is required."""
    try:
        return make()
    except Exception as e:
        if required:
            raise
        log.warning("channel left out: %s", e)
        return like.limit(0)
