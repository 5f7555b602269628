"""Problem 7: the whole corpus as ids of a public byte-level BPE tokenizer.

The method is a streaming transducer with bounded lookahead. The longest token of the merge list, L bytes, bounds how
far back a later byte can reach: the last token of any longer prefix starts within the last L bytes. The transducer
keeps, for each prefix end in that window, the last token of the prefix's encoding. That token is the one that ends
there and stays whole beside the prefix's previous token when the two are encoded together. As soon as the chains from
all ends in the window share a boundary, everything before it can't change any more and is emitted; what is kept stays
constant, however long the text is.

Two facts of the merge list shorten the work without changing a result: no token spans a pair of bytes that stand side
by side in no token of the list, so texts are cut at such pairs; and equal pieces have equal ids, so those of frequent
pieces are kept in a table of bounded size.

Defined results: null and empty texts give an empty list. White space alone is encoded as any text. Strings of special
tokens are ordinary text. Lone surrogates can't occur in Spark strings.
"""

from __future__ import annotations

import base64
import codecs
import os
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.arrow import lists, through
from tessella.sources.tables import spread, table

#: Where the public vocabulary lies; a parameter of every function here.
VOCABULARY = os.environ.get("TESSELLA_BPE", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the public pre-tokenisation pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces kept with their ids by a worker; the table is emptied when full.
KEPT = 1 << 17


class Transducer:
    """Encodes one pre-token after another; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, kept: int = KEPT):
        self.ranks, self.kept = ranks, kept
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern)
        self.inside = np.zeros(65536, dtype=bool)
        for t in ranks:
            for a, b in zip(t, t[1:]):
                self.inside[a * 256 + b] = True
        self.inside = self.inside.tobytes()
        self.by_end: dict[int, list[int]] = {}
        lengths: dict[int, set[int]] = {}
        for t in ranks:
            lengths.setdefault(t[-1], set()).add(len(t))
        self.by_end = {k: sorted(v, reverse=True) for k, v in lengths.items()}
        self.stays: dict[tuple[bytes, bytes], bool] = {}
        self.ids: dict[str, array] = {}
        self.parts: dict[bytes, array] = {}

    def merged(self, b: bytes) -> list[bytes]:
        """The merges of the list applied in order of rank, from the left. Only for pairs of tokens."""
        parts = [b[i : i + 1] for i in range(len(b))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def beside(self, a: bytes, b: bytes) -> bool:
        """Whether both tokens stay whole when they are encoded together."""
        k = (a, b)
        if (known := self.stays.get(k)) is None:
            if len(self.stays) >= self.kept:
                self.stays.clear()
            known = self.stays[k] = self.merged(a + b) == [a, b]
        return known

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Ids of the bytes, emitted as soon as they are stable."""
        ranks, longest = self.ranks, self.longest
        buf, base, last = bytearray(), 0, {}  # last[e]: the last token of the prefix that ends at e, absolute
        for e, x in enumerate(data, 1):
            buf.append(x)
            for n in self.by_end[x]:
                s = e - n
                if s < base:
                    continue
                t = bytes(buf[s - base :])
                if t in ranks and (s == 0 or self.beside(last[s], t) if s == 0 or s in last else s == base):
                    last[e] = t
                    break
            if e - base >= 4 * longest:
                yield from self.settle(buf, base, last, e)
                base = e - len(buf)
        yield from self.back(last, base, base + len(buf))

    def settle(self, buf: bytearray, base: int, last: dict[int, bytes], e: int) -> Iterator[int]:
        """Emits what the chains from all ends in the window share and forgets it."""
        ends = {k for k in range(max(base + 1, e - self.longest), e + 1) if k in last}
        while len(ends) > 1:
            k = max(ends)
            ends.remove(k)
            ends.add(k - len(last[k]))
        stable = ends.pop()
        if stable > base:
            yield from self.back(last, base, stable)
            del buf[: stable - base]
            keep = last.get(stable)
            for k in [k for k in last if k < stable]:
                del last[k]
            if keep is not None:
                last[stable] = keep

    def back(self, last: dict[int, bytes], base: int, e: int) -> list[int]:
        out = []
        while e > base:
            t = last[e]
            out.append(self.ranks[t])
            e -= len(t)
        return out[::-1]

    def part(self, b: bytes) -> array:
        if (r := self.ranks.get(b)) is not None and len(b) == 1:
            return array("i", [r])
        known = self.parts.get(b)
        if known is None:
            known = array("i", self.stream(b))
            if len(b) <= 64:
                if len(self.parts) >= self.kept:
                    self.parts.clear()
                self.parts[b] = known
        return known

    def piece(self, text: str) -> array:
        b = text.encode()
        if len(b) < 4 or text.isascii():
            return self.part(b)
        out, start, inside = array("i"), 0, self.inside
        for i in range(1, len(b)):
            if not inside[b[i - 1] * 256 + b[i]]:
                out.extend(self.part(b[start:i]))
                start = i
        out.extend(self.part(b[start:]))
        return out

    def encode_into(self, text: str, out: array) -> None:
        ids, get = self.ids, self.ids.get
        for m in self.split.findall(text) if len(text) < 1 << 16 else (m[0] for m in self.split.finditer(text)):
            if (known := get(m)) is None:
                known = self.piece(m)
                if len(m) <= 48:
                    if len(ids) >= self.kept:
                        ids.clear()
                    ids[m] = known
            out.extend(known)

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        if text:
            self.encode_into(text, out)
        return out.tolist()


class Decoder:
    """Bytes of ids to text, one id at a time; incomplete characters wait for their rest."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = {v: k for k, v in ranks.items()}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, i: int) -> str:
        return self.state.decode(self.bytes[i])

    def close(self) -> str:
        out = self.state.decode(b"", True)
        self.state.reset()
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return "".join([*map(self.push, ids), self.close()])


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def transducer(path: str = VOCABULARY) -> Transducer:
    return Transducer(ranks_of(path))


def encode_column(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """(key, ids array<int>), one row for each row. A map over the rows, without a shuffle."""

    def make():
        t = transducer(path)

        def batch(c: dict[str, list]) -> dict[str, list]:
            flat, ends = array("i"), []
            for x in c["text"]:
                if x:
                    t.encode_into(x, flat)
                ends.append(len(flat))
            return {"key": c["key"], "ids": lists(np.frombuffer(flat, dtype=np.int32) if flat else np.zeros(0, np.int32), ends, pa.int32())}

        return batch

    kind = df.schema[key].dataType.simpleString()
    return through(df.select(F.col(key).alias("key"), F.col(text).alias("text")), make, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_column(spread(table(spark, folder, "documents", "doc_id", "text")), "doc_id", "text")
