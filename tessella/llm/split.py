"""Problem 1: cutting oversized texts at natural boundaries, with overlap.

A token is a run of ASCII letters or digits, which one hyphen or apostrophe may join to one more run, or one character
from U+4E00 to U+9FFF. Before each token stands a gap, and the gap gives the strength of a cut there: paragraph, list
item or table row, line, sentence, clause, space, nothing. A piece starts `overlap` tokens before the cut that ended
the piece before it; a sparse table of range maxima over the strengths finds the strongest cut in the window of
permissible lengths, the rightmost among equals. Permissible is every length from a quarter of the way between overlap and limit, so
that each piece brings text of its own; only where that window holds no sentence end or stronger cut, shorter lengths are asked.

Defined results: null gives no piece; a text of at most `limit` tokens, empty and blank ones among them, gives itself as
one piece; characters before the first and after the last token belong to the first and last piece. Joining
content[from new_start on] of all pieces gives the text again, character by character. A text without any boundary is
cut at the limit. Equal rows give equal pieces.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.arrow import through
from tessella.llm.tables import texts

LIMIT, OVERLAP = 420, 40
#: Fixed value: what counts as a token.
TOKEN = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)?|[一-鿿]"
_TOKEN = re.compile(TOKEN)
_PARAGRAPH = re.compile(r"\n[ \t]*\r?\n|\r[ \t]*\r")
_ITEM = re.compile(r"\n[ \t]*(?:[-*+•|#>]|$)")
_SENTENCE = re.compile(r"[.!?](?:[\"'”’)\]]*)\s|[.!?]$|[。！？]|…\s")
_CLAUSE = re.compile(r"[;；:：]\s?|[，、]|,\s|[–—]")
SENTENCE = 4


def strength(gap: str, first: str) -> int:
    """Of a cut in the gap before a token. first: the token's first characters, for numbered items."""
    if "\n" in gap or "\r" in gap:
        if _PARAGRAPH.search(gap):
            return 7
        return 6 if _ITEM.search(gap) or first else 5
    if len(gap) == 1 and gap == " ":
        return 1
    if _SENTENCE.search(gap):
        return SENTENCE
    if gap.startswith((";", "；")):
        return 3
    if _CLAUSE.search(gap):
        return 2
    return 1 if gap and not gap.strip() else 0 if not gap else 1 if " " in gap else 0


class Maxima:
    """Sparse table: the position of the greatest value in any range, the rightmost among equals."""

    def __init__(self, values: np.ndarray):
        self.values = values
        level = np.arange(len(values))
        self.levels = [level]
        while (half := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            a, b = level[:-half], level[half:]
            level = np.where(values[a] > values[b], a, b)
            self.levels.append(level)

    def __call__(self, low: int, high: int) -> int:
        """In low..high, both included."""
        k = (high - low + 1).bit_length() - 1
        a, b = int(self.levels[k][low]), int(self.levels[k][high - (1 << k) + 1])
        return a if self.values[a] > self.values[b] else b


_NUMBERED = re.compile(r"\d{1,3}[.)]\s")


def pieces(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """(start, new_start, end, tokens) of each piece, as offsets in the text."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    if text is None:
        return []
    spans = [m.span() for m in _TOKEN.finditer(text)]
    n = len(spans)
    if n <= limit:
        return [(0, 0, len(text), n)]
    gaps = [strength(text[a:b], text[b : b + 1] if _NUMBERED.match(text, b) else "") for (_, a), (b, _) in zip(spans, spans[1:])]
    best = Maxima(np.array([0, *gaps, 9]))
    # a cut at i stands before token i; the characters of a gap up to its last line break or space stay with the left piece
    out, start, new = [], 0, 0
    char_start = char_new = 0
    while True:
        if n - start <= limit:
            out.append((char_start, char_new, len(text), n - start))
            return out
        high = start + limit
        least = max(new + 1, start + overlap + 1)
        at = best(min(high, max(least, start + overlap + (limit - overlap) // 4)), high)
        if best.values[at] < SENTENCE:
            shorter = best(least, high)
            at = shorter if best.values[shorter] > best.values[at] else at
        end = cut_char(text, spans[at - 1][1], spans[at][0])
        out.append((char_start, char_new, end, at - start))
        new, start = at, at - overlap
        char_new, char_start = end, cut_char(text, spans[start - 1][1], spans[start][0]) if overlap else end


def cut_char(text: str, a: int, b: int) -> int:
    """Where in the gap a..b the next piece starts: after closing punctuation and space, before opening marks."""
    gap = text[a:b]
    if "\n" in gap:
        return a + gap.rfind("\n") + 1
    i = max(gap.rfind(" "), gap.rfind("\t"), gap.rfind("　"))
    if i >= 0:
        return a + i + 1
    i = max(gap.rfind(c) for c in "。！？；，、：）”’")
    return a + i + 1 if i >= 0 else b


def split_column(df: DataFrame, text: str, *keys: str, limit: int = LIMIT, overlap: int = OVERLAP, oversized: bool = False) -> DataFrame:
    """Each row's pieces: keys, piece_index, n_pieces, start, new_start, end, n_tokens, content. oversized: only of texts over the
    limit, which are found in the JVM, so that other texts never reach Python."""

    def make():
        def batch(c: dict[str, list]) -> dict[str, list]:
            out = {k: [] for k in (*keys, "piece_index", "n_pieces", "start", "new_start", "end", "n_tokens", "content")}
            for i, x in enumerate(c["__text"]):
                ps = pieces(x, limit, overlap)
                for j, (s, f, e, t) in enumerate(ps):
                    for k in keys:
                        out[k].append(c[k][i])
                    for k, v in (("piece_index", j), ("n_pieces", len(ps)), ("start", s), ("new_start", f), ("end", e), ("n_tokens", t), ("content", x[s:e])):
                        out[k].append(v)
            return out

        return batch

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    if oversized:
        df = df.filter(F.length(text) > limit).filter(F.regexp_count(text, F.lit(TOKEN)) > limit)
    df = df.select(*keys, F.col(text).alias("__text"))
    return through(df, make, f"{kinds}, piece_index int, n_pieces int, start int, new_start int, end int, n_tokens int, content string")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Items that the splitter cuts; a row delivered again gives the key once."""
    items = split_column(texts(spark, folder, sections="content", chunks="content"), "content", "item_kind", "item_key", oversized=True)
    return items.filter("piece_index = 1").select("item_kind", "item_key").distinct()


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all oversized sections and chunks."""
    items = split_column(texts(spark, folder, sections="content", chunks="content"), "content", "item_kind", "item_key", oversized=True)
    return items.dropDuplicates(["item_kind", "item_key", "piece_index", "content"])


P1_FOUND_SQL = """
WITH t AS (
  SELECT 'section' AS item_kind, CAST(section_id AS VARCHAR) AS item_key, content FROM sections
  UNION ALL SELECT 'chunk', chunk_id, content FROM chunks)
SELECT DISTINCT item_kind, item_key FROM t
WHERE len(regexp_extract_all(content, '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[\\x{4e00}-\\x{9fff}]')) > 420
"""
