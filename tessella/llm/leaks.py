"""Problem 8: held-out items that leak into training text.

Text and items are brought to one visual form (see visual), case-folded and cut into units: words (runs of letters and
digits) for items of scripts with spaces, single letters and digits for Chinese ones. A window has as many units as make
a leak: 12 words, 24 characters. Each window is embedded by the CGK random walk, which reads a unit, writes it and then
moves on or not by a random bit of the step and the unit, so that few edits become few differing places of a fixed-length
string. Repeated sampling of some of its places gives keys; windows of texts and of items that share a key are
compared, by exact equality or, with max_edits > 0, by banded edit distance. Equal windows share every key, so that for
max_edits = 0 nothing is missed; `samples_for` gives how many places and samples reach a recall for edited ones, and is an
error where none do.

Items up to HELD characters are held by the workers, and texts are scanned once, without a shuffle. Beyond that the keys of
both sides are joined by a shuffle: texts give a number, a key and a document for each window, candidates are made distinct,
and only candidates' texts are read again and compared. Both ways give the same rows.

Defined results: null, empty and short texts leak nothing; an item shorter than a window is looked for whole; an item
repeated in a text, or repeated rows of items with one id, give one row. Whole texts are scanned.
"""

from __future__ import annotations

import re
from functools import lru_cache
from math import comb

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.arrow import through
from tessella.llm.visual import VisualForm, compiled, held_form
from tessella.sources.tables import spread, table

WORDS, CHARS = 12, 24
#: Characters of items that workers hold; more are joined.
HELD = 2_000_000
#: Places sampled for a key at most, and keys of a window at most.
PLACES, SAMPLES = 16, 256
_UNIT = re.compile(r"[㐀-䶿一-鿿豈-﫿]|[^\W_㐀-䶿一-鿿豈-﫿]+")
_WORD = re.compile(r"[^\W_]+")
_CHAR = re.compile(r"[^\W_]")
_HAN = re.compile(r"[㐀-䶿一-鿿豈-﫿]")
_M = (1 << 64) - 1


def units(text: str, chars: bool, form: VisualForm) -> list[str]:
    folded = form(text).casefold()
    return (_CHAR if chars else _UNIT if _HAN.search(folded) else _WORD).findall(folded)


def walk(codes: np.ndarray, length: int, mix: np.ndarray) -> np.ndarray:
    """The embedding of a window in each row. mix: the walk's random numbers, by row and step."""
    rows, n = np.arange(len(codes)), codes.shape[1]
    pos, out = np.zeros(len(codes), np.int64), np.zeros(mix.shape, np.uint64)
    for j in range(mix.shape[1]):
        inside = pos < length
        out[:, j] = np.where(inside, codes[rows, np.minimum(pos, n - 1)], np.uint64(0))
        pos += inside & ((out[:, j] * mix[:, j]) >> np.uint64(63) > 0)
    return out


@lru_cache(maxsize=64)
def places_apart(edits: int, length: int, patterns: int = 128, walks: int = 128) -> np.ndarray:
    """By simulation: how many of the first places, by which a walk is through about every window, differ between the embeddings of a window and of an edited one, for random patterns of edits and random
    walks. Two walks seldom meet again after an edit, so that the number has a long tail and several walks are needed."""
    rng = np.random.default_rng(88)
    out = np.zeros((patterns, walks), np.int64)
    for p in range(patterns):
        plain = rng.integers(1, 1 << 63, length + edits + 1, dtype=np.uint64)
        changed = plain.tolist()
        for _ in range(edits):
            at, how = int(rng.integers(length)), int(rng.integers(3))
            changed[at : at + (how != 1)] = [int(x) for x in rng.integers(1, 1 << 63, int(how != 2), dtype=np.uint64)]
        mix = rng.integers(1, 1 << 63, (walks, 3 * length), dtype=np.uint64) | np.uint64(1)
        a, b = (walk(np.tile(np.array(x, np.uint64), (walks, 1)), length, mix) for x in (plain, changed))
        out[p] = (a != b)[:, : 2 * length].sum(1)
    return out


@lru_cache(maxsize=64)
def samples_for(recall: float, edits: int, length: int) -> tuple[int, int]:
    """(places, samples), each sample of a walk of its own, by which windows of this many edits share a key with this probability: the most
    places, which give the fewest false candidates, for which SAMPLES are enough; an error if none are."""
    out = 2 * length
    if not edits:
        return min(PLACES, out), 1
    apart = places_apart(edits, length)
    for places in range(min(PLACES, out), 0, -1):
        hit = np.array([comb(out - d, places) / comb(out, places) for d in range(out + 1)])[apart].mean(1)
        n = next((n for n in (*range(1, 33), *range(36, SAMPLES + 1, 4)) if (1 - (1 - hit) ** n).mean() >= recall), None)
        if n:
            return places, n
    raise ValueError(f"{SAMPLES} samples don't reach a recall of {recall} for {edits} edits in {length} units")


class Keys:
    """LSH keys of all windows of a sequence of unit codes: for each sample a walk of its own and some of its places."""

    def __init__(self, length: int, places: int = PLACES, samples: int = 1, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.length, self.steps = length, 3 * length
        self.mix = rng.integers(1, 1 << 63, (samples, self.steps), dtype=np.uint64) | np.uint64(1)
        # of the first places: later ones stand behind the window in most walks, and would be alike in all
        self.at = [np.sort(rng.choice(2 * length, min(places, 2 * length), replace=False)) for _ in range(samples)]
        self.weight = rng.integers(1, 1 << 63, (samples, self.steps), dtype=np.uint64) | np.uint64(1)

    def __call__(self, codes: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """samples x windows, of the windows that start at `start`, or of all. A sequence shorter than a window is one
        window, as if followed by nothing. The walk is done for many windows at once, a step at a time."""
        n, w = len(codes), self.length
        if start is None:
            start = np.arange(max(n - w + 1, 1 if n else 0))
        padded = np.concatenate([codes, np.zeros(w + 1, np.uint64)])
        keys = np.zeros((len(self.at), len(start)), np.uint64)
        for a in range(0, len(start), 1 << 14):
            s = start[a : a + (1 << 14)]
            end = s + w
            for r, places in enumerate(self.at):
                used, k, pos = set(places.tolist()), keys[r, a : a + (1 << 14)], s.copy()
                for j in range(int(places[-1]) + 1):
                    now = padded[pos]
                    if j >= w:
                        inside = pos < end
                        now *= inside
                    if j in used:
                        k += now * self.weight[r, j]
                    bit = ((now * self.mix[r, j]) >> np.uint64(63)).view(np.int64)
                    pos += bit if j < w else bit & inside
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0x9E3779B97F4A7C15)
        return keys


class Codes(dict):
    """A 64-bit code for a unit."""

    def __missing__(self, unit: str) -> int:
        h = 0xCBF29CE484222325
        for b in unit.encode():
            h = ((h ^ b) * 0x100000001B3) & _M
        h ^= h >> 31
        h = h * 0x9E3779B97F4A7C15 & _M
        h ^= h >> 32
        if len(self) < 1 << 18:
            self[unit] = h
        return h


def within(a: list[str], b: list[str], most: int) -> bool:
    """Whether a equals the beginning of b up to `most` edits: banded edit distance."""
    if most == 0:
        return b[: len(a)] == a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row) > most:
            return False
    return min(row) <= most


class Items:
    """The windows of items of one kind, by key."""

    def __init__(self, items: list[tuple[int, str]], length: int, chars: bool, form: VisualForm, places: int = PLACES, samples: int = 1):
        self.length, self.chars, self.keys_of = length, chars, Keys(length, places, samples)
        self.units = {i: units(x, chars, form) for i, x in items}
        codes = Codes()
        ids, at, keys = [], [], []
        self.short = {i: u for i, u in self.units.items() if 0 < len(u) < length}
        for i, u in self.units.items():
            if len(u) >= length:
                k = self.keys_of(np.array([codes[x] for x in u], np.uint64))
                keys.append(k)
                ids += [i] * k.shape[1]
                at += range(k.shape[1])
        self.table = []
        for r in range(samples if keys else 0):
            k = np.concatenate([x[r] for x in keys])
            order = np.argsort(k, kind="stable")
            self.table.append((k[order], np.array(ids, np.int64)[order], np.array(at, np.int64)[order]))

    def __len__(self) -> int:
        return len(self.table[0][0]) if self.table else 0

    def found(self, us: list[list[str]], codes: Codes, most: int = 0) -> set[tuple[int, int]]:
        """(row, item) of the rows' units that hold a window of an item."""
        out: set[tuple[int, int]] = set()
        lengths = np.array([len(u) for u in us], np.int64)
        if not self.units or not lengths.sum():
            return out
        flat = np.fromiter((codes[x] for u in us for x in u), np.uint64, int(lengths.sum()))
        first = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(us)), np.maximum(lengths - self.length + 1, 0))
        each = np.maximum(lengths - self.length + 1, 0)
        start = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        self.look(self.keys_of(flat, start), row, start - first[row], us, most, out)
        for i, item in self.short.items():  # an item shorter than a window, anywhere in a row
            out |= {(r, i) for r, u in enumerate(us) if any(within(item, u[k : k + len(item) + most], most) for k, x in enumerate(u) if most or x == item[0])}
        return out

    def look(self, keys: np.ndarray, row: np.ndarray, at_row: np.ndarray, us: list[list[str]], most: int, out: set) -> None:
        for r, (k, ids, at) in enumerate(self.table):
            low = np.searchsorted(k, keys[r])
            hit = np.flatnonzero(k[np.minimum(low, len(k) - 1)] == keys[r])
            for w in hit.tolist():
                j, u, x, key = int(low[w]), us[row[w]], int(at_row[w]), keys[r][w]
                while j < len(k) and k[j] == key:
                    found = (int(row[w]), int(ids[j]))
                    if found not in out:
                        a = self.units[found[1]][at[j] : at[j] + self.length]
                        if within(a, u[x : x + len(a) + most], most):
                            out.add(found)
                    j += 1


def leaks(texts: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", *, words: int = WORDS, chars: int = CHARS, max_edits: int = 0, recall: float = 0.99, held: int = HELD) -> DataFrame:
    """(key, item_id) of texts that hold a window of an item. items: item_id, lang, text."""
    kept = items.filter("text IS NOT NULL").dropDuplicates(["item_id", "text"]).select("item_id", F.coalesce(F.col("lang").isin("zh", "ja"), F.lit(False)).alias("chars"), "text")
    df = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    total = kept.agg(F.sum(F.length("text"))).first()[0] or 0
    plan = {c: (n, *samples_for(recall, max_edits, n)) for c, n in ((False, words), (True, chars))}
    out = _by_workers(df, kept, plan, max_edits) if total <= held else _by_join(df, kept, plan, max_edits, recall)
    return out.withColumnRenamed("key", key)


def _by_workers(df: DataFrame, items: DataFrame, plan: dict[bool, tuple[int, int, int]], max_edits: int) -> DataFrame:
    """Items are at most HELD characters, which has been checked."""
    sc = df.sparkSession.sparkContext
    rows, table_ = sc.broadcast([tuple(r) for r in items.collect()]), sc.broadcast(compiled())

    def make():
        form = held_form(table_)
        kinds = [Items([(i, x) for i, c, x in rows.value if c == use_chars], n, use_chars, form, places, samples) for use_chars, (n, places, samples) in plan.items()]
        codes = (Codes(), Codes())

        def batch(c: dict[str, list]) -> dict[str, list]:
            ks, ids = [], []
            for of, cs in zip(kinds, codes):
                if not of.units:
                    continue
                rows_ = [i for i, x in enumerate(c["text"]) if x and (not of.chars or _HAN.search(x))]
                for a in range(0, len(rows_), 256):
                    some = rows_[a : a + 256]
                    for r, i in sorted(of.found([units(c["text"][i], of.chars, form) for i in some], cs, max_edits)):
                        ks.append(c["key"][some[r]])
                        ids.append(i)
            return {"key": ks, "item_id": ids}

        return batch

    return through(df, make, f"key {df.schema['key'].dataType.simpleString()}, item_id bigint")


def _by_join(df: DataFrame, items: DataFrame, plan: dict[bool, tuple[int, int, int]], max_edits: int, recall: float) -> DataFrame:
    """Any number of items. Items shorter than a window have keys of their own length, of which there are less than a window's units."""
    table_ = df.sparkSession.sparkContext.broadcast(compiled())

    def sized(c: dict[str, list], form: VisualForm) -> list[tuple[int, bool, list[str]]]:
        """(row, whether by characters, units): of an item the one that is its script's, of a text both."""
        both = c.get("chars") or [None] * len(c["text"])
        return [(i, use, units(x, use, form)) for i, (x, own) in enumerate(zip(c["text"], both)) if x for use in plan if own in (None, use) and (own is not None or not use or _HAN.search(x))]

    def lengths():
        form = held_form(table_)
        return lambda c: dict(zip(("chars", "n"), map(list, zip(*{(use, min(len(u), plan[use][0])) for _, use, u in sized(c, form) if u})))) if any(c["text"]) else {"chars": [], "n": []}

    # at most as many rows as a window has units, for each script
    found = sorted({(r.chars, r.n) for r in through(items.select("chars", "text"), lengths, "chars boolean, n int").distinct().collect()})
    each = {(use, n): plan[use] if n == plan[use][0] else (n, *samples_for(recall, max_edits, n)) for use, n in found}

    def keyed(of: DataFrame, name: str) -> DataFrame:
        def make():
            form, codes = held_form(table_), (Codes(), Codes())
            keys = {k: Keys(*v) for k, v in each.items()}

            def batch(c: dict[str, list]) -> dict[str, list]:
                ids, ks = [], []
                for i, use, u in sized(c, form):
                    flat = np.fromiter((codes[use][x] for x in u), np.uint64, len(u))
                    for (chars, n), k in keys.items():
                        if chars == use and len(u) >= n and ("chars" not in c or n == min(len(u), plan[use][0])):
                            # a key says which sample, script and length it is of
                            got = np.unique(k(flat) + np.arange(1, len(k.at) + 1, dtype=np.uint64)[:, None] * np.uint64(2 * n + chars)).view(np.int64)
                            ks += got.tolist()
                            ids += [c[name][i]] * len(got)
                return {name: ids, "window": ks}

            return batch

        return through(of, make, f"{name} {of.schema[name].dataType.simpleString()}, window bigint")

    pairs = keyed(df, "key").join(keyed(items, "item_id"), "window").select("key", "item_id").distinct()
    both = pairs.join(df, "key").join(items.select("item_id", "chars", F.col("text").alias("item")), "item_id")

    def verify():
        form, codes = held_form(table_), Codes()

        def batch(c: dict[str, list]) -> dict[str, list]:
            hold = [bool(Items([(0, x)], plan[use][0], use, form, *plan[use][1:]).found([units(t, use, form)], codes, max_edits)) for x, use, t in zip(c["item"], c["chars"], c["text"])]
            return {k: [v for v, h in zip(c[k], hold) if h] for k in ("key", "item_id")}

        return batch

    return through(both.select("key", "item_id", "chars", "item", "text"), verify, f"key {df.schema['key'].dataType.simpleString()}, item_id bigint").distinct()


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(spread(table(spark, folder, "documents", "doc_id", "text")), table(spark, folder, "eval_items", "item_id", "lang", "text"))
