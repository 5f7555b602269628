"""Problem 9: one form for texts that look the same, and documents that read alike but are coded differently.

A transducer goes over a text once and always takes the longest match: a grapheme cluster of a base with its combining and
invisible characters, a run of white space, a sequence of Hangul jamo, or a run of characters that are written otherwise. What it
writes is compiled once, on the driver, by rule from the Unicode tables for every code point, and checked before it is
used: invisible characters go, compatibility forms (widths, ligatures, coded forms of one sign) are resolved but for raised and
lowered characters and fractions, look-alike letters become the Latin letter, accents are composed. The check is that
what an entry writes maps to itself, so that no two entries are in conflict, and that composed and decomposed letters
are written alike. Workers get the compiled table. Runs of white space become one space.

Defined results: null stays null, empty and blank texts become empty; case, digits, words, missing accents and raised
digits stay different. Text is taken whole, whatever its length.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata as U
from functools import lru_cache

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.arrow import through
from tessella.sources.tables import spread, table

#: Letters of other scripts that look like a Latin letter, as public confusables tables have them.
LOOKALIKE = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ү": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "ϲ": "c", "ϳ": "j", "ρ": "p", "υ": "u", "κ": "k",
    "ɡ": "g", "ɑ": "a", "ı": "i", "ꞌ": "'", "ⅼ": "l", "օ": "o", "ս": "u", "հ": "h", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꮶ": "K", "Ꮇ": "M", "Ꮲ": "P", "Ꭲ": "T",
    "‐": "-", "‑": "-", "﹣": "-", "⁃": "-",
}
_INVISIBLE = {chr(c) for c in (0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, 0x3164, 0xFEFF, 0xFFA0, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE0080), *range(0xE0100, 0xE01F0))}


#: Parts over which the members of one coding are spread.
SALTS = 16


def _kept(c: str) -> bool:
    """Raised and lowered characters, fractions and free-standing accents keep their form."""
    return U.decomposition(c).startswith(("<super>", "<sub>", "<fraction>", "<compat> 0020"))


def _one(cluster: str) -> str:
    """What is written for a cluster, by rule."""
    base = "".join(c for c in cluster if c not in _INVISIBLE)
    out = "".join(c if _kept(c) else U.normalize("NFKC", c) for c in U.normalize("NFD", base))
    out = "".join(LOOKALIKE.get(c, c) for c in U.normalize("NFD", out))
    return U.normalize("NFC", out)


_COMBINING = "\u0300-\u034e\u0350-\u036f\u0483-\u0489\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ufe20-\ufe2f"


def _class(chars: set[str]) -> str:
    """A character class of ranges."""
    out, at = [], sorted(map(ord, chars))
    for c in at:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(re.escape(chr(a)) + (f"-{re.escape(chr(b))}" if b > a else "") for a, b in out)


@lru_cache(maxsize=1)
def compiled() -> dict[int, str]:
    """What is written for each code point that isn't written as it is, "" for nothing; checked for conflicts."""
    table: dict[int, str] = {}
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c in _INVISIBLE:
            table[i] = ""
        elif c.isspace():
            table[i] = " "
        elif (c in LOOKALIKE or U.decomposition(c)) and (to := _one(c)) != c:  # all others are written as they are
            table[i] = to
    for i, to in table.items():
        if any(table.get(ord(x), x) != x for x in to if to != " "):
            raise ValueError(f"conflict: {chr(i)!r} is written {to!r}, which maps on")
        if U.normalize("NFC", to) != to or _one(U.normalize("NFD", chr(i))) != to and to not in ("", " "):
            raise ValueError(f"conflict: {chr(i)!r} is written otherwise when it is decomposed")
    return table


class VisualForm:
    """The transducer; see the module's text. table: of compiled(). Its longest matches are a cluster of a base with what combines with
    it, a syllable of jamo, and a run of characters that are written otherwise or of spaces; where nothing in a text combines, only
    the last can match, and only it is tried."""

    def __init__(self, table: dict[int, str]) -> None:
        self.table = table
        self.known: dict[str, str] = {}
        hidden, other = _class(_INVISIBLE), _class({chr(c) for c in table} - {" "})
        run = f"[{other}](?:[{other} ](?!{{0}}))*| [\\s{hidden}]+"
        after = f"[{hidden}]*[{_COMBINING}]"
        self.runs = re.compile(f"[{other}][{other} ]*| [\\s{hidden}]+")
        self.clusters = re.compile(f"[^\\s{_COMBINING}]?{after}[{hidden}{_COMBINING}]*|[\u1100-\u1112][{hidden}]*[\u1161-\u1175][{hidden}]*[\u11a8-\u11c2]?|{run.format(after)}")
        self.combines = re.compile(f"[{_COMBINING}\u1100-\u1112]")
        self.spaces = re.compile(r"\s+")

    def write(self, m: re.Match[str]) -> str:
        x = m[0]
        if (known := self.known.get(x)) is None:
            known = _one(x) if self.combines.search(x) else self.spaces.sub(" ", x.translate(self.table))
            if len(self.known) < 1 << 16 and len(x) <= 8:
                self.known[x] = known
        return known

    def __call__(self, text: str) -> str:
        return (self.clusters if self.combines.search(text) else self.runs).sub(self.write, text).strip()


@lru_cache(maxsize=1)
def visual_form() -> VisualForm:
    return VisualForm(compiled())


def held_form(held: Broadcast) -> VisualForm:
    """The transducer of a broadcast table, made once in a worker."""
    table_ = held.value
    if _MADE.get("table") is not table_:
        _MADE.update(table=table_, form=VisualForm(table_))
    return _MADE["form"]


_MADE: dict[str, object] = {}


def visual_column(df: DataFrame, text: str, *keys: str, name: str = "canonical") -> DataFrame:
    """keys and the one form of the text; null stays null. A map, without a shuffle."""

    held = df.sparkSession.sparkContext.broadcast(compiled())

    def make():
        f = held_form(held)
        return lambda c: {k: c[k] for k in keys} | {name: [None if x is None else f(x) for x in c["__text"]]}

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return through(df.select(*keys, F.col(text).alias("__text")), make, f"{kinds}, {name} string")


def reading_keys(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, reads, coded): 128-bit digests of the one form and of the characters as they are. Null and blank texts have none."""

    held = df.sparkSession.sparkContext.broadcast(compiled())

    def make():
        f = held_form(held)

        def batch(c: dict[str, list]) -> dict[str, list]:
            out = {"key": [], "reads": [], "coded": []}
            for k, x in zip(c["key"], c["text"]):
                if x and (y := f(x)):
                    out["key"].append(k)
                    out["reads"].append(hashlib.blake2b(y.encode(), digest_size=16).digest())
                    out["coded"].append(hashlib.blake2b(x.encode(), digest_size=16).digest())
            return out

        return batch

    kind = df.schema[key].dataType.simpleString()
    return through(df.select(F.col(key).alias("key"), F.col(text).alias("text")), make, f"key {kind}, reads binary, coded binary")


def pairs_reading_alike(keys: DataFrame) -> DataFrame:
    """Pairs whose texts read the same but are coded differently. Readings with one coding, as any number of exact copies has, never form
    a pair. For the others pairs of codings are formed, not of members, and each is then opened to its members by two equi-joins, so
    that the work is as large as the result; members of a coding are split over SALTS parts for it, so that a hot one isn't one task's."""
    from tessella.session import cut

    keys = cut(keys.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")))
    codings = keys.groupBy("reads", "coded").agg(F.count("*").alias("n"))
    several = codings.join(codings.groupBy("reads").agg(F.count("*").alias("codings")).filter("codings > 1"), "reads", "left_semi")
    a, b = (several.select("reads", F.col("coded").alias(c), F.col("n").alias(f"n{c}")) for c in ("x", "y"))
    # x is the coding with more members: it is opened last, against what the lesser one has become
    pairs = a.join(b, "reads").filter("x != y AND (nx > ny OR nx = ny AND x < y)").select("x", "y")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    members = keys.select("coded", "key", "salt")
    lesser = pairs.select("x", F.col("y").alias("coded"), salts).join(members, ["coded", "salt"]).select("x", F.col("key").alias("other"))
    both = lesser.select(F.col("x").alias("coded"), "other", salts).join(members, ["coded", "salt"])
    return both.select(F.least("key", "other").alias("doc_id_a"), F.greatest("key", "other").alias("doc_id_b"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs_reading_alike(reading_keys(spread(table(spark, folder, "documents", "doc_id", "text")), "doc_id", "text"))
