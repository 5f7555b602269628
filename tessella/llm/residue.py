"""Problem 2: unfilled templates, filler, error pages and notices in titles and abstracts.

Three models of character n-grams are fitted: of filler and of notices from labelled phrases that are made by rule (seeds), and
of natural prose from all training texts and all headings of bodies. For each character the likelihood ratio of the better residue
model to prose is summed in windows; windows that favour residue are the located residue. A unit that they cover to COVERAGE
or more is residue and is excluded. Units are sentences, parts between wide gaps, and what stands between marks such
as a form has around its fields, as an unfilled placeholder may stand in any sentence.

Counts of prose are exact above a rate (see counts). Defined results: null and empty fields aren't residue; nor is punctuation
alone. Letter case doesn't matter, numbers are alike. A field is judged whole, whatever its length; equal rows are
judged equally.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import seeds
from tessella.llm.arrow import through
from tessella.llm.chars import codes
from tessella.llm.counts import Counts, characters, counted, frequent, summed
from tessella.sources.tables import spread, table

ORDER = 4
#: N-grams with this share of all characters or less count as unseen; so at most ORDER / RATE are collected and broadcast.
RATE = 2e-8
WINDOW, MARKED_WINDOW, COVERAGE, LEAST = 9, 3, 0.6, 4.0
#: How strongly an order leans on the one below: as many observations, and a share of those of its context, so that a model of much text
#: isn't surer than one of little that it has seen all.
LEAN, MIX = 3.0, 0.05
#: Weight of labelled prose in a corpus of a million characters.
NOTES = 0.5
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def folded(text: str) -> np.ndarray:
    """Codes of the text in lower case with all digits alike, between line breaks."""
    c = codes("\n" * (ORDER - 1) + text + "\n").copy()
    c[(c >= 65) & (c <= 90)] += 32
    c[(c >= 48) & (c <= 57)] = 48
    return c


def ngrams(c: np.ndarray, order: int) -> np.ndarray:
    """64-bit keys of the n-gram that ends at each character from the ORDER-th on."""
    n = len(c) - (ORDER - 1)
    h = np.full(n, order, np.uint64)
    for k in range(order):
        at = ORDER - 1 - k
        h = (h ^ (c[at : at + n].astype(np.uint64) + np.uint64(k + 1)) * _MIX[k]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
    return h | np.uint64(1)


class NGrams:
    """Counts of n-grams of all orders, and the interpolated probability of each character after those before it."""

    def __init__(self, counts: Counts, total: float):
        self.counts, self.total = counts, total

    @classmethod
    def of(cls, phrases: list[str]) -> NGrams:
        c = folded("\n\n\n".join(phrases))
        return cls(Counts(*summed(np.concatenate([ngrams(c, k + 1) for k in range(ORDER)]))), float(len(c)))

    def plus(self, other: NGrams, weight: float) -> NGrams:
        keys, n = (np.concatenate(x) for x in zip(*((m.counts.keys[m.counts.n > 0], m.counts.n[m.counts.n > 0] * w) for m, w in ((self, 1.0), (other, weight)))))
        keys, at = np.unique(keys, return_inverse=True)
        return NGrams(Counts(keys, np.bincount(at, n, len(keys))), self.total + weight * other.total)

    def log(self, keys: list[np.ndarray]) -> np.ndarray:
        """keys: of each order, of one text."""
        seen = [self.counts(k) for k in keys]
        p = (seen[0] + 0.05) / (self.total + 1000)
        for k in range(1, ORDER):
            # the n-gram before a character is the shorter one that ends a place earlier
            context = np.concatenate([[0], seen[k - 1][:-1]])
            lean = LEAN + MIX * context
            p = (seen[k] + lean * p) / (context + lean)
        return np.log(p)


def prose_model(df: DataFrame, *columns: str) -> NGrams:
    """Over all rows of the columns."""

    def keys(texts: list[str]) -> np.ndarray:
        c = folded("\n\n\n".join(texts))
        return np.concatenate([ngrams(c, k + 1) for k in range(ORDER)])

    total = characters(df, *columns)
    return NGrams(Counts(*frequent(counted(df, columns, keys, 64), RATE * total)), float(total))


#: Where a form's marks may open and close around a field; what stands between them decides.
MARKED = re.compile(r"(?:[{\[<(«〔【（〈《%$#@|]|&lt;|__)+[^{}\[\]<>«»〔〕【】（）〈〉《》|\n]{1,80}?(?:[}\]>)»〕】）〉》%$@|]|&gt;|__)+")
_SEGMENT = re.compile(r"[^\n.!。！…]*(?:[.!…](?!\s|$)[^\n.!。！…]*)*(?:[.!。！…]+|\n|$)\s*")
_WIDE = re.compile(r"\s{2,}")


class Residue:
    def __init__(self, prose: NGrams, filler: list[str] | None = None, notices: list[str] | None = None):
        # in proportion to the corpus, so that they weigh alike at every size
        self.prose = prose.plus(NGrams.of(_numbered(seeds.notes())), NOTES * max(1e6, prose.total) / 1e6)
        self.filler, self.notice = NGrams.of(_numbered(filler or seeds.filler())), NGrams.of(_numbered(notices or seeds.notices()))

    def ratios(self, texts: list[str]) -> list[np.ndarray]:
        """Of each character of each text two rows: the better residue model against prose, in nats, as the mean of the wide and of the narrow
        window around it."""
        c = folded("\n\n\n".join(texts))
        keys = [ngrams(c, k + 1) for k in range(ORDER)]
        prose = self.prose.log(keys)
        ends = np.cumsum([len(x) + 3 for x in texts])
        outside = np.zeros(len(prose), bool)
        for k in (1, 2, 3):
            outside[np.minimum(ends - k, len(prose) - 1)] = True
        each = []
        for m in (self.filler, self.notice):
            r = m.log(keys) - prose
            r[outside] = 0
            each.append([np.convolve(r, np.ones(w) / w, "same") for w in (WINDOW, MARKED_WINDOW)])
        best = np.maximum(*np.array(each))
        return [best[:, e - 3 - len(x) : e - 3] for x, e in zip(texts, ends)]

    def residue(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Of each field the spans that are residue."""
        return [self.spans(x, r) for x, r in zip(texts, self.ratios(texts))] if texts else []

    def spans(self, text: str, r: np.ndarray) -> list[tuple[int, int]]:
        letters = np.fromiter((x.isalnum() for x in text), bool, len(text))

        def covered(row: np.ndarray, a: int, b: int) -> bool:
            of = row[a:b][letters[a:b]]
            return len(of) >= 2 and (of > 0).mean() >= COVERAGE and of.sum() > LEAST

        # a field has a name
        out = [m.span() for m in MARKED.finditer(text) if sum(map(str.isalpha, m[0])) >= 2 and covered(r[1], *m.span())]
        for m in _SEGMENT.finditer(text):
            at = m.start()
            for part in _WIDE.split(m[0]):
                start = text.find(part, at) if part else at
                at = start + len(part)
                if covered(r[0], start, at):
                    out.append((start, at))
        return sorted(out)


def _numbered(phrases: list[str]) -> list[str]:
    return [p.replace("<n>", "000") for p in phrases]


def residue_column(df: DataFrame, key: str, fields: tuple[str, ...], prose: NGrams) -> DataFrame:
    """(key, field_name, kept, found) for each row and field: whether it holds residue, and the field without it."""
    held = df.sparkSession.sparkContext.broadcast(prose)
    kind = df.schema[key].dataType.simpleString()

    def make():
        model = Residue(held.value)
        known: dict[str, list[tuple[int, int]]] = {"": []}

        def batch(c: dict[str, list]) -> dict[str, list]:
            new = sorted({x for f in fields for x in c[f] if x and x not in known})
            if len(known) + len(new) > 1 << 16:
                known.clear()
                known[""] = []
                new = sorted({x for f in fields for x in c[f] if x})
            for at in range(0, len(new), 256):
                known.update(zip(new[at : at + 256], model.residue(new[at : at + 256])))
            out: dict[str, list] = {"key": [], "field_name": [], "found": [], "kept": []}
            for i, k in enumerate(c["key"]):
                for f in fields:
                    x = c[f][i]
                    kept, at = "", 0
                    spans = known[x or ""]
                    for a, b in spans:
                        kept += x[at:a] if a > at else ""
                        at = max(at, b)
                    for n, v in (("key", k), ("field_name", f), ("found", bool(spans)), ("kept", x if not spans else (kept + x[at:]).strip())):
                        out[n].append(v)
            return out

        return batch

    return through(df.select(F.col(key).alias("key"), *fields), make, f"key {kind}, field_name string, found boolean, kept string").withColumnRenamed("key", key)


def prose_columns(documents: DataFrame) -> DataFrame:
    """text, and the headings of a body, which are prose as titles are."""
    heads = F.array_join(F.regexp_extract_all("content_md", F.lit(r"(?m)^#{1,6}[^\S\n]+(\S[^\r\n]*)"), F.lit(1)), "\n")
    return documents.select("text", heads.alias("headings"))


def _fields(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "documents", "doc_id", "title", "abstract", "text", "content_md"))
    return residue_column(d.select("doc_id", "title", "abstract"), "doc_id", ("title", "abstract"), prose_model(prose_columns(d), "text", "headings"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(spark, folder).filter("found").select("doc_id", "field_name")


def p2_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Titles and abstracts without residue, as cards, views and search may use them; a field that is only residue is empty."""
    return _fields(spark, folder).select("doc_id", "field_name", "kept")
