"""Counts of characters and character pairs over all of a corpus."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tessella.llm.counts import Counts, characters, counted, frequent

#: Pairs with this share of all characters or less count as unseen; so at most 1 / RATE are collected and broadcast.
RATE = 2e-8
_ONE = np.uint64(1 << 63)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pair_keys(c: np.ndarray) -> np.ndarray:
    """Of each character with the one after it: both numbers in one, which no other pair has."""
    return (c[:-1].astype(np.uint64) << np.uint64(21) | c[1:].astype(np.uint64)) + np.uint64(1)


@dataclass
class PairModel:
    """singles: by code point."""

    counts: Counts
    singles: np.ndarray

    def __post_init__(self) -> None:
        self.total = float(self.singles.sum())

    def pairs(self, c: np.ndarray) -> np.ndarray:
        return self.counts(pair_keys(c))

    def log(self, text: str) -> np.ndarray:
        """The log probability of each character after the one before it; the text is taken to begin after a line break."""
        return self.log_codes(codes("\n" + text))

    def log_codes(self, c: np.ndarray) -> np.ndarray:
        return np.log((self.pairs(c) + 0.02) / (self.singles[c[:-1]] + 20.0))

    def seen(self, text: str) -> np.ndarray:
        """How often each pair of the text is in the corpus."""
        return self.pairs(codes(text))


def pair_model(df: DataFrame, text: str) -> PairModel:
    """Counted over all rows."""

    def keys(texts: list[str]) -> np.ndarray:
        c = codes("\n" + "\n".join(texts) + "\n")
        return np.concatenate([pair_keys(c), c.astype(np.uint64) | _ONE])

    k, n = frequent(counted(df, (text,), keys), RATE * characters(df, text))
    one = k >= _ONE
    singles = np.zeros(sys.maxunicode + 1, np.float32)
    singles[(k[one] ^ _ONE).astype(np.int64)] = n[one]
    return PairModel(Counts(k[~one], n[~one]), singles)
