"""Exact counts of what is frequent in a corpus.

Tasks count, the shuffle sums, and what has a share above a rate comes to the driver and from there to the workers: at most
1 / rate keys, however large the corpus is, and each with its exact count. What is rarer counts as unseen, at every size of
the corpus alike. Keys are 64-bit numbers in an open-addressing table with keys kept, so that no two keys share a count.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EMPTY = np.uint64(0)


def hash64(text: str) -> int:
    """Of a text, never 0."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") or 1


class Counts:
    """An open-addressing table with linear probing, filled and read by whole arrays. Keys aren't 0."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.n = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.float32)
        keys, n = keys.astype(np.uint64), n.astype(np.float32)
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] == _EMPTY
            spot, first = np.unique(at[free], return_index=True)
            which = np.flatnonzero(free)[first]
            self.keys[spot], self.n[spot] = keys[which], n[which]
            left = np.ones(len(keys), bool)
            left[which] = False
            keys, n, at = keys[left], n[left], (at[left] + 1) & (len(self.keys) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.n[at], np.float32(0))
        more = np.flatnonzero((found != keys) & (found != _EMPTY))
        while len(more):
            at = (at[more] + 1) & (len(self.keys) - 1) if len(at) != len(more) else (at + 1) & (len(self.keys) - 1)
            found, want = self.keys[at], keys[more]
            hit = found == want
            out[more[hit]] = self.n[at[hit]]
            go = ~hit & (found != _EMPTY)
            more, at = more[go], at[go]
        return out

    def one(self, key: int) -> float:
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        last = len(self.keys) - 1
        while (k := int(self.keys[at])) != key:
            if not k:
                return 0.0
            at = (at + 1) & last
        return float(self.n[at])


def summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, with their sum."""
    if n is None:
        return np.unique(keys, return_counts=True)
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, n, len(keys)).astype(np.int64)


def counted(df: DataFrame, columns: tuple[str, ...], keys_of: Callable[[list[str]], np.ndarray], rows: int = 512) -> DataFrame:
    """(key, n) over all texts of the columns. A task sums its own keys before they are shuffled; it holds no more than what it sums
    between two emptyings."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def batch():
            k, n = summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])) if len(held) > 1 else held[0]
            held.clear()
            return k, n

        def out(k, n):
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

        for b in batches:
            for col in b.columns:
                for at in range(0, len(col), rows):
                    texts = [x for x in col.slice(at, rows).to_pylist() if x]
                    if texts:
                        held.append(summed(keys_of(texts)))
                        size += len(held[-1][0])
                        if size > 1_000_000:
                            k, n = batch()
                            if len(k) > 500_000:
                                yield out(k, n)
                                k, n = k[:0], n[:0]
                            held.append((k, n))
                            size = len(k)
        if held:
            yield out(*batch())

    return df.select(*columns).mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, more_than: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of those above a count that is a rate of the whole."""
    got = counts.filter(F.col("n") > F.lit(float(more_than))).toArrow()
    return got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy()


def characters(df: DataFrame, *columns: str) -> int:
    """Of all texts: what rates are taken of."""
    return int(df.agg(sum((F.coalesce(F.sum(F.length(c)), F.lit(0)) for c in columns), F.lit(0)).alias("n")).first()[0])
