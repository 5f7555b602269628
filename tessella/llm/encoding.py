"""Problem 4: text that was decoded with a wrong character encoding.

The latent variable of each line is the chain of encodings that garbled it, or none. A line that holds character pairs
unknown to the corpus is tried against all chains: each turns what it could have made back into bytes and decodes them
again. The evidence for a chain is the log-likelihood ratio of the restored line to the line as it is under a model of
character pairs counted over all training texts. No chain is chosen for a line beforehand: the evidence of all of them,
however weak, goes into expectation-maximization, which estimates for each source and field the share of lines that each
chain garbled from the posteriors of all their lines, and takes it as the prior of the next posteriors. So one source's
clear lines decide between chains that restore a weak line alike. The lines' evidence is first counted by source, field and
rounded ratios, so that a source of any size is as many counts as it has different evidence. A record is repaired, line by
line, by the likeliest chain, if the chains together have a posterior of one half.

A line with U+FFFD has lost characters: it is found, and what is left is restored as far as a chain fits.

Defined results: null and empty texts aren't found and stay as they are; so do lines of ASCII, real accents, capitals,
signs and rare characters, and characters misread in scanning. Line ends are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.arrow import through
from tessella.llm.chars import PairModel, codes, pair_model
from tessella.session import cut
from tessella.sources.tables import spread, table

#: Encodings by which UTF-8 bytes, GB bytes, or Windows-1252 bytes were wrongly read.
SINGLE = ("windows", "mac_roman", "cp1251", "cp437", "cp850", "cp866", "koi8-r", "cp1250")
MULTI = ("gb18030", "big5", "cp932")
GB_AS = ("windows", "mac_roman", "cp1251", "cp437")
LATIN_AS = ("cp850", "cp437", "mac_roman", "cp1251", "cp1250", "koi8-r", "gb18030")
#: Ratios are rounded to whole nats. Above the one they are all certain, as no prior is less than 1 in e^30 lines; below the other
#: no prior of at most CEILING brings a posterior of one half.
MOST, CEILING = 40, 0.95
LOWEST = math.floor(-math.log(CEILING / (1 - CEILING)))


@lru_cache(maxsize=None)
def to_byte(name: str) -> dict[str, int]:
    """Of the upper half; "windows" is Windows-1252 with the C1 controls where it has no character."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode("cp1252" if name == "windows" else name)
        except UnicodeDecodeError:
            c = chr(b) if name == "windows" else None
        if c is not None:
            out[c] = b
    if name == "windows":
        out |= {chr(b): b for b in range(128, 160)}
    return out


def _set(name: str, low: int, high: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in to_byte(name).items() if low <= b <= high) + "]"


def _utf8_as(name: str) -> Callable[[str], str]:
    c = _set(name, 0x80, 0xBF)
    pattern = re.compile(f"{_set(name, 0xC2, 0xDF)}{c}|{_set(name, 0xE0, 0xEF)}{c}{c}|{_set(name, 0xF0, 0xF4)}{c}{c}{c}")
    byte = to_byte(name)

    def one(m: re.Match[str]) -> str:
        try:
            return bytes(byte[x] for x in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]

    return lambda line: pattern.sub(one, line)


def _gb_as(name: str) -> Callable[[str], str]:
    pattern = re.compile(f"(?:{_set(name, 0xA1, 0xFE)}{_set(name, 0xA1, 0xFE)})+")
    byte = to_byte(name)

    def one(m: re.Match[str]) -> str:
        try:
            return bytes(byte[x] for x in m[0]).decode("gb18030")
        except UnicodeDecodeError:
            return m[0]

    # one pair alone may be two accented capitals
    return lambda line: pattern.sub(one, line) if any(m.end() - m.start() >= 4 for m in pattern.finditer(line)) else line


def _utf8_as_multi(name: str) -> Callable[[str], str]:
    pattern = re.compile("[^\x00-\x7f�]+")

    def one(m: re.Match[str]) -> str:
        try:
            back = m[0].encode(name).decode("utf-8")
        except UnicodeError:
            return m[0]
        if any(c > "\u2e7f" for c in back) or all(c <= "\u00ff" or "\u2000" <= c < "\u2300" for c in back):
            return back
        around = m.string[max(0, m.start() - 1) : m.start()] + m.string[m.end() : m.end() + 1]
        return back if any(c.isascii() and c.isalpha() for c in around) else m[0]  # a rare letter stands in a Latin word

    return lambda line: pattern.sub(one, line)


def _latin_as(name: str) -> Callable[[str], str]:
    if name == "gb18030":
        pattern = re.compile(r"(?<=[A-Za-zÀ-ÿ])[一-鿿]+")

        def run(m: re.Match[str]) -> str:
            try:
                return m[0].encode("gb18030").decode("cp1252")
            except UnicodeError:
                return m[0]

        return lambda line: pattern.sub(run, line)
    byte = to_byte(name)
    swap = {}
    for c, b in byte.items():
        try:
            swap[ord(c)] = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            pass
    return lambda line: line.translate(swap)


def _twice(f: Callable[[str], str]) -> Callable[[str], str]:
    return lambda line: f(f(line))


@lru_cache(maxsize=1)
def chains() -> dict[str, Callable[[str], str]]:
    out = {f"utf-8 as {n}": _utf8_as(n) for n in SINGLE}
    out |= {f"utf-8 as {n}, twice": _twice(_utf8_as(n)) for n in ("windows", "mac_roman", "cp437", "cp1251")}
    out |= {f"utf-8 as {n}": _utf8_as_multi(n) for n in MULTI}
    out |= {f"gb18030 as {n}": _gb_as(n) for n in GB_AS}
    out |= {f"windows as {n}": _latin_as(n) for n in LATIN_AS}
    return out


LOST = "lost characters"


#: Nats for each character less, or each wide one less, when bytes turn out to be valid UTF-8: that isn't so by chance.
VALID, VALID_WIDE = 3.0, 2.0


def _wide(x: str) -> int:
    return sum(c > "\u2e7f" for c in x)


def evidence(line: str, model: PairModel) -> list[tuple[str, float, str]]:
    """(chain, log-likelihood ratio, restored line) of all chains that can have made the line, the strongest first."""
    plain, out = None, []
    known: dict[str, float] = {}
    for name, undo in chains().items():
        back = undo(line)
        if back == line:
            continue
        if name.startswith("windows as") and len(line) == len(back):
            # one for one: all pairs around a changed character must be known
            changed = np.flatnonzero(codes(line) != codes(back))
            seen = model.seen("\n" + back + "\n")
            if seen[changed].min() == 0 or seen[changed + 1].min() == 0:
                continue
        if back not in known:
            # letters of a script that the corpus doesn't know can't have stood here
            fit = all(c < "\u0250" or "\u1e00" <= c < "\u1f00" or "\u2000" <= c < "\u2300" or c > "\u2e7f" or model.singles[ord(c)] for c in set(back) - set(line))
            plain = model.log(line).sum() if plain is None and fit else plain
            known[back] = float(model.log(back).sum() - plain) if fit else -math.inf
        ratio = known[back]
        if name.startswith("utf-8 as"):
            ratio += VALID * max(0, len(line) - len(back)) if name.split(",")[0][9:] in SINGLE else VALID_WIDE * max(0, _wide(line) - _wide(back))
        if ratio >= LOWEST:
            out.append((name, ratio, back))
    return sorted(out, key=lambda e: -e[1])


def suspicious_lines(xs: list[str], model: PairModel) -> dict[int, list[tuple[int, str]]]:
    """By text, the numbered lines that hold a pair with a non-ASCII character which the corpus doesn't know."""
    out: dict[int, list[tuple[int, str]]] = {}
    flat = codes("\n".join(xs) + "\n")
    if len(flat) < 2:
        return out
    a, b = flat[:-1], flat[1:]
    rare = np.minimum(model.singles[a], model.singles[b]) <= model.total * 5e-6
    mixed = (a < 128) != (b < 128)
    odd = np.flatnonzero(((a > 127) | (b > 127)) & (((model.pairs(flat) == 0) & (rare | mixed)) | (b == 0xFFFD)))
    if not len(odd):
        return out
    ends = np.cumsum([len(x) + 1 for x in xs])
    for i in np.unique(np.searchsorted(ends, odd, side="right")).tolist():
        start = int(ends[i]) - len(xs[i]) - 1
        own = odd[(odd >= start) & (odd < ends[i])] - start
        lines, at = xs[i].split("\n"), 0
        for n, line in enumerate(lines):
            if ((own >= at - 1) & (own <= at + len(line))).any():
                out.setdefault(i, []).append((n, line))
            at += len(line) + 1
    return out


def records(spark: SparkSession, folder: str) -> DataFrame:
    """(item_kind, item_key, source, content): bodies and cards' flags; whoever delivered them is the source."""
    d = table(spark, folder, "documents").selectExpr("'document' item_kind", "cast(doc_id as string) item_key", "source_institution source", "content_md content")
    c = table(spark, folder, "document_cards").selectExpr("'card' item_kind", "doc_id item_key", "source_institution source", "cleaning_flags content")
    return spread(d).unionByName(spread(c))


def names() -> list[str]:
    return [*chains(), LOST]


def signature(found: list[tuple[str, float, str]], lost: bool) -> str:
    """Of a line the chains, by number, with their rounded ratios: lines of one signature are one case."""
    at = {n: i for i, n in enumerate(names())}
    each = sorted((at[n], min(MOST, math.floor(r))) for n, r, _ in found)
    return ",".join(f"{i}:{r}" for i, r in [*each, *([(at[LOST], MOST)] if lost else [])])


def line_evidence(df: DataFrame, model: PairModel) -> DataFrame:
    """A row for a line that some chain can have made: item_kind, item_key, source, line, signature."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def make():
        known: dict[str, str] = {}  # of lines that come often, such as headings

        def of(line: str) -> str:
            if len(line) > 60:
                return signature(evidence(line, held.value), "\ufffd" in line)
            if line not in known:
                if len(known) >= 1 << 15:
                    known.clear()
                known[line] = signature(evidence(line, held.value), "\ufffd" in line)
            return known[line]

        def batch(c: dict[str, list]) -> dict[str, list]:
            out = {k: [] for k in ("item_kind", "item_key", "source", "line", "signature")}
            rows = [i for i, x in enumerate(c["content"]) if x and not x.isascii()]
            for at in range(0, len(rows), 256):
                some = rows[at : at + 256]
                for j, lines in suspicious_lines([c["content"][i] for i in some], held.value).items():
                    for n, line in lines:
                        if sig := of(line):
                            i = some[j]
                            for k, v in (("item_kind", c["item_kind"][i]), ("item_key", c["item_key"][i]), ("source", c["source"][i] or ""), ("line", n), ("signature", sig)):
                                out[k].append(v)
            return out

        return batch

    return through(df, make, "item_kind string, item_key string, source string, line int, signature string")


#: Pseudo-counts of lines that no chain garbled, and that a chain did.
CLEAN, GARBLED = 50.0, 0.5


def maximized(signatures: list[str], n: np.ndarray, records: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each signature the posterior that some chain garbled its lines, and the number of the likeliest chain."""
    ratio = np.full((len(n), len(names())), -np.inf)
    for i, s in enumerate(signatures):
        for x in s.split(","):
            k, r = x.split(":")
            ratio[i, int(k)] = int(r)
    there = np.isfinite(ratio).any(0)
    total = max(records, float(n.sum())) + CLEAN
    share = np.where(there, GARBLED / total, 0.0)
    for _ in range(50):
        with np.errstate(divide="ignore"):
            odds = np.exp(np.log(share) - math.log(max(1e-9, 1 - share.sum())) + ratio)
        post = odds / (1 + odds.sum(1, keepdims=True))
        new = np.where(there, (GARBLED + n @ post) / (total + GARBLED * there.sum()), 0.0)
        new *= min(1.0, CEILING / new.sum())
        moved = np.abs(np.log(new[there] / share[there])).max()
        share = new
        if moved < 1e-3:
            break
    real = post[:, :-1]
    return post.sum(1), np.where(real.max(1) > 0, real.argmax(1), len(names()) - 1)


def posteriors(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """(source, item_kind, signature, chain, posterior) by expectation-maximization over each source's counts. sizes: source,
    item_kind, records."""
    counts = lines.groupBy("source", "item_kind", "signature").agg(F.count("*").alias("n")).join(sizes, ["source", "item_kind"])

    def em(g: pd.DataFrame) -> pd.DataFrame:
        p, chain = maximized(g["signature"].tolist(), g["n"].to_numpy(float), float(g["records"].iloc[0]))
        return g[["source", "item_kind", "signature"]].assign(chain=[names()[k] for k in chain], posterior=p)

    return counts.groupBy("source", "item_kind").applyInPandas(em, "source string, item_kind string, signature string, chain string, posterior double")


def garbled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """item_kind, item_key, line, chain, posterior of all lines that are more likely garbled than not."""
    model = pair_model(spread(table(spark, folder, "documents", "text")), "text")
    all_ = records(spark, folder)
    lines = cut(line_evidence(all_, model))
    sizes = all_.groupBy(F.coalesce("source", F.lit("")).alias("source"), "item_kind").agg(F.count("*").alias("records"))
    post = posteriors(lines, sizes)
    return lines.join(post, ["source", "item_kind", "signature"]).filter("posterior >= 0.5").select("item_kind", "item_key", "line", "chain", "posterior")


def restore(text: str, how: dict[int, str]) -> str:
    lines = text.split("\n")
    for n, chain in how.items():
        if n < len(lines) and chain != LOST:
            lines[n] = chains()[chain](lines[n])
    return "\n".join(lines)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return garbled_lines(spark, folder).select("item_kind", "item_key").distinct()


def p4_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Each garbled record with its text restored where that can be; of a card delivered again, each different text. Documents have one
    row each, so that only cards, whose flags are short, are reduced."""
    how = garbled_lines(spark, folder).groupBy("item_kind", "item_key").agg(F.array_distinct(F.collect_list(F.struct("line", "chain"))).alias("how"))
    both = records(spark, folder).join(how, ["item_kind", "item_key"]).select("item_kind", "item_key", "content", "how")

    def make():
        def batch(c: dict[str, list]) -> dict[str, list]:
            return {"item_kind": c["item_kind"], "item_key": c["item_key"], "restored": [x and restore(x, {h["line"]: h["chain"] for h in how}) for x, how in zip(c["content"], c["how"])]}

        return batch

    kind = "item_kind string, item_key string, restored string"
    cards = through(both.filter("item_kind = 'card'"), make, kind).distinct()
    return through(both.filter("item_kind = 'document'"), make, kind).unionByName(cards)
