"""Sections and blocks to chunks: units of one meaning packed to a token budget, atomic pieces, parents, and their links.

Texts are cut by offsets: a scan gives the boundaries, running sums of tokens give where a budget ends, and a piece is the slice of the
text between two boundaries, with its own spacing. Packing never looks at single tokens.

Defined results: null and empty texts, and texts of a heading alone, give no part; a unit over the limit is cut by a sliding window.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.batches import expand
from tessella.functions.text import TOKEN, token_count
from tessella.operators.markdown import find_blocks

#: Budgets and patterns.
TARGET, MOST, OVERLAP = 300, 420, 40
ATOMIC_MOST, ATOMIC_OVERLAP, SECTION_MOST = 900, 80, 3000
_TOKEN = re.compile(TOKEN)
_UNIT = re.compile(r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)?|\S")
_HEAD = re.compile(r"^\s*#{1,6}\s+.+?(?:\n+|$)")
_BULLET = re.compile(r"^\s*(?:[-*+•]|\d+[.)]|\([a-zA-Z0-9]+\))\s+")
_TABLE = re.compile(r"^\s*(?:\|.*\||(?:table|fig(?:ure)?|algorithm)\s+\d*[:.\s].*|表\s*\d*[:：.\s].*)", re.I)
_SENTENCE = re.compile(r"(?<=[.!?;。！？；])\s+|(?<=[。！？；])")
_ACTION = re.compile(r"\b(should|recommend|recommended|suggest|suggests|offer|avoid|consider|is indicated|are indicated|may be used|should not|do not)\b|(推荐|建议|应该|应|宜|不建议)", re.I)
_NO_ACTION = re.compile(r"\b(return to recommendations|future research|recommendation for research|grade for quality|wording evidence|not enough evidence to make|committee made a recommendation|we recommend[.]{3}|we suggest[.]{3})\b|(未来研究|方法学|证据分级)", re.I)
_PICO = re.compile(r"(\bPICO\b|clinical question|key question|population|intervention|comparator|outcome|临床问题|关键问题|人群|干预|对照|结局)", re.I)
_EVIDENCE = re.compile(r"(evidence|certainty|quality of evidence|systematic review|meta-analysis|GRADE|证据|证据质量|证据等级|系统评价|荟萃)", re.I)
_SCOPE = re.compile(r"(scope|target population|intended audience|applicability|eligib|范围|适用|目标人群|适用对象)", re.I)
_BACKGROUND = re.compile(r"(background|introduction|epidemiology|背景|前言|引言)", re.I)
_NUMBERED = re.compile(r"(?m)^\s*(?=(?:\d+(?:\.\d+)+|Recommendation\s+\d+[A-Za-z]?)\b)")
_ADVICE = re.compile(r"^\s*(?:[-*+]\s*)?(?:we recommend|we suggest|do not offer|offer|consider|should|should not|is recommended|is not recommended)\b", re.I)
#: Type, what speaks for it, what speaks against it; the first that holds.
TYPES = (("recommendation", _ACTION, _NO_ACTION), ("pico", _PICO, None), ("evidence", _EVIDENCE, None), ("scope_population", _SCOPE, None))
KEPT_TYPES = frozenset(("recommendation", "pico", "evidence", "scope_population", "table", "conclusion", "background"))
#: Block types whose long texts are cut.
LONG_TYPES = frozenset(("evidence_candidate", "rationale_candidate", "background", "unknown"))

PARTS = "part_index int, content string, chunk_type string, token_count int"


def count(text: str) -> int:
    return sum(1 for _ in _TOKEN.finditer(text))


def semantic_type(text: str, section: str = "other") -> str:
    """The first rule that fits, else the section's type."""
    flat = " ".join(text.split())
    if not flat or section == "reference":
        return section
    rows = [bool(_TABLE.search(x)) for x in text.splitlines() if x.strip()]
    if 2 * sum(rows) >= max(2, len(rows) - len(rows) % 2):
        return "table"
    found = next((name for name, speaks, against in TYPES if speaks.search(flat) and not (against and against.search(flat))), None)
    return found or (section if section in KEPT_TYPES else "background" if _BACKGROUND.search(flat) else "other")


def budgets(n: np.ndarray, target: int | None, most: int) -> list[tuple[int, int]]:
    """Consecutive groups (from, to): a group ends with the item that reaches the target, and before the one that would pass the limit."""
    total = np.cumsum(n)
    out, at = [], 0
    while at < len(n):
        base = total[at - 1] if at else 0
        end = int(np.searchsorted(total, base + most, side="right"))
        if target is not None:
            end = min(end, int(np.searchsorted(total, base + target, side="left")) + 1)
        end = max(at + 1, end)
        out.append((at, end))
        at = end
    return out


def window_pieces(text: str, most: int, overlap: int) -> list[str]:
    """Slices of at most `most` units, each beginning `overlap` units before the end of the one before."""
    spans = [m.span() for m in _UNIT.finditer(text)]
    step = max(1, most - overlap)
    starts = range(0, max(1, len(spans) - overlap), step) if len(spans) > most else (0,)
    return [text[spans[s][0] : spans[min(s + most, len(spans)) - 1][1]] for s in starts if s < len(spans)]


def units(content: str) -> Iterable[str]:
    """A table each, a list's items, a paragraph each. Blank lines and a change between table and text part them."""
    lines = content.splitlines()
    full = np.array([bool(x.strip()) for x in lines], bool)
    row = np.array([bool(_TABLE.search(x.strip())) for x in lines], bool)
    edge = np.flatnonzero(np.concatenate([[True], (full[1:] != full[:-1]) | (row[1:] != row[:-1])])) if lines else []
    for a, b in zip(edge, [*edge[1:], len(lines)]):
        if not full[a]:
            continue
        some = [x.strip() for x in lines[a:b]]
        if row[a]:
            yield "\n".join(some)
        elif len(some) > 1 and all(map(_BULLET.match, some)):
            yield from filter(None, (_BULLET.sub("", x).strip() for x in some))
        else:
            yield " ".join(some)


def semantic_parts(content: str | None, section: str = "other", target: int = TARGET, most: int = MOST, overlap: int = OVERLAP) -> list[tuple[str, str, int]]:
    """(content, type, tokens) of parts of one type each."""
    texts, kinds = [], []
    for unit in units(_HEAD.sub("", content or "", count=1)):
        of = semantic_type(unit, section)
        some = [unit] if of == "table" or count(unit) <= TARGET else list(filter(str.strip, _SENTENCE.split(unit)))
        texts += [x.strip() for x in some]
        kinds += [semantic_type(x, of) for x in some]
    sizes = np.array([count(x) for x in texts], np.int64)
    keep = np.flatnonzero(sizes)
    texts, kinds, sizes = [texts[i] for i in keep], [kinds[i] for i in keep], sizes[keep]
    # a run ends where the type changes, and before and after a unit over the limit
    over = sizes > most
    edge = [i for i in range(len(texts)) if not i or kinds[i] != kinds[i - 1] or over[i] or over[i - 1]]
    out: list[tuple[str, str, int]] = []
    for a, b in zip(edge, [*edge[1:], len(texts)]):
        if over[a]:
            cut = window_pieces(texts[a], most, 0 if kinds[a] in ("recommendation", "table") else overlap)
            out += [(x, kinds[a], n) for x in cut if (n := count(x))]
        else:
            out += [("\n\n".join(texts[a + i : a + j]), kinds[a], int(sizes[a + i : a + j].sum())) for i, j in budgets(sizes[a:b], target, most)]
    return out


def _find_parts(of: dict[str, list]) -> tuple[list[int], dict[str, list]]:
    rows: list[int] = []
    out: dict[str, list] = {"part_index": [], "content": [], "chunk_type": [], "token_count": []}
    for r, (x, t) in enumerate(zip(of["content"], of["type"])):
        ps = semantic_parts(x, t or "other")
        rows += [r] * len(ps)
        out["part_index"] += range(len(ps))
        for name, i in (("content", 0), ("chunk_type", 1), ("token_count", 2)):
            out[name] += [p[i] for p in ps]
    return rows, out


def chunk_sections(sections: DataFrame, *keys: str) -> DataFrame:
    """Chunks of sections by meaning. keys stay; part_index counts within a section."""
    from tessella.operators.classify import section_type

    kind = section_type(F.coalesce("heading", F.lit("")), F.col("section_path"), F.col("content"))
    if "is_reference_section" in sections.columns:
        kind = F.when(F.coalesce("is_reference_section", F.lit(False)), "reference").otherwise(kind)
    typed = sections.select(*keys, F.col("content").alias("__content"), kind.alias("__type"))
    return expand(typed, {"content": "__content", "type": "__type"}, keys, PARTS, _find_parts)


def summary_chunks(documents: DataFrame, body: str, title: str, *keys: str) -> DataFrame:
    """A `summary` of each document whose sections give no part, which is one without a token outside its headings: its lines without
    marks up to 1,200 characters, after its title. That is decided in the scan, without a join."""
    text = F.regexp_replace(F.coalesce(body, F.lit("")), r"\r\n?", "\n")
    bare = documents.filter(token_count(F.regexp_replace(text, r"(?m)^#{1,6}[^\S\n]+\S[^\n]*", "")) == 0)
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"^[ #*\t]+|[ #*\t]+$", "")), lambda x: (x != "") & ~x.startswith("<!--"))
    own = F.trim(F.coalesce(title, F.lit("")))
    taken = F.aggregate(lines, F.struct(F.lit("").alias("t"), F.lit(0).alias("n")), lambda acc, x: F.when(acc["n"] >= 1200, acc).otherwise(F.struct(F.trim(F.concat_ws(" ", acc["t"], x)).alias("t"), (acc["n"] + F.length(x)).alias("n"))))["t"]
    x = bare.select(*keys, own.alias("__title"), F.coalesce(F.nullif(taken, F.lit("")), own).alias("__t"))
    has = F.substring(F.col("__t"), F.lit(1), F.greatest(F.lit(80), F.length("__title") + 20)).contains(F.col("__title"))
    content = F.substring(F.when((F.col("__title") != "") & ~has, F.concat_ws(" ", "__title", "__t")).otherwise(F.col("__t")), 1, 2000)
    return x.select(*keys, content.alias("content"), F.array("__title").alias("section_path")).filter("content != ''").withColumns({"chunk_type": F.lit("summary"), "token_count": token_count("content")})


def chunk_documents(documents: DataFrame, body: str, title: str, key: str) -> DataFrame:
    """(key, section_index, part_index, section_path, content, chunk_type, token_count) of bodies, from their sections or as a summary."""
    from tessella.operators.markdown import parse_sections

    parts = chunk_sections(parse_sections(documents, body, key), key, "section_index", "section_path")
    rest = summary_chunks(documents, body, title, key).withColumns({"section_index": F.lit(0), "part_index": F.lit(0)})
    return parts.unionByName(rest)


def number_chunks(chunks: DataFrame, doc: str, *order: str) -> DataFrame:
    """chunk_index and id by the order within each document."""
    w = Window.partitionBy(doc).orderBy(*order)
    x = chunks.withColumn("chunk_index", F.row_number().over(w) - 1)
    return x.withColumn("chunk_id", F.format_string("%s#chunk_%05d", doc, "chunk_index"))


def recommendations(text: str | None) -> list[str]:
    """A text at its numbers (two or more), else its lines if several recommend."""
    t = text or ""
    at = [m.start() for m in _NUMBERED.finditer(t)]
    lines = [x.strip() for x in t.splitlines() if x.strip()]
    if len(at) < 2:
        return lines if sum(map(bool, map(_ADVICE.match, lines))) > 1 else [t.strip()] if t.strip() else []
    return list(filter(None, (t[a:b].strip() for a, b in zip(at, [*at[1:], len(t)]))))


def atomic_parts(text: str | None, block_type: str) -> list[str]:
    """Recommendations apart; long texts by paragraphs up to the limit, a paragraph over it by a sliding window; others whole."""
    if block_type == "recommendation_candidate":
        return recommendations(text)
    if block_type not in LONG_TYPES:
        return [text] if text and text.strip() else []
    some = [x.strip() for x in re.split(r"\n\s*\n", text or "") if x.strip()]
    n = np.array([count(x) for x in some], np.int64)
    edge = [i for i in range(len(some)) if not i or n[i] > ATOMIC_MOST or n[i - 1] > ATOMIC_MOST]
    out: list[str] = []
    for a, b in zip(edge, [*edge[1:], len(some)]):
        if n[a] > ATOMIC_MOST:
            out += window_pieces(some[a], ATOMIC_MOST, ATOMIC_OVERLAP)
        else:
            out += ["\n\n".join(some[a + i : a + j]) for i, j in budgets(n[a:b], None, ATOMIC_MOST)]
    return out


def _find_atoms(of: dict[str, list]) -> tuple[list[int], dict[str, list]]:
    parts = [atomic_parts(x, t) for x, t in zip(of["text"], of["type"])]
    return [r for r, p in enumerate(parts) for _ in p], {"part_index": [i for p in parts for i in range(len(p))], "content": [x for p in parts for x in p]}


def atomic_chunks(blocks: DataFrame, doc: str) -> DataFrame:
    """The smallest chunks, of blocks that are neither headings nor tables, with their id and warnings."""
    keys = [doc, "order_index", "heading_path", "page", "block_type"]
    x = expand(blocks.filter("kind = 'text'"), {"text": "text", "type": "block_type"}, keys, "part_index int, content string", _find_atoms)
    n, t = token_count("content"), F.col("block_type")
    warnings = F.array_compact(F.array(
        F.when(n > ATOMIC_MOST, "chunk_too_long"), F.when(n < 10, "chunk_too_short"), F.when(F.size("heading_path") == 0, "heading_missing"), F.when(F.col("page").isNull(), "missing_page_span"),
        F.when(t == "reference", "reference_chunk_detected"), F.when(t == "method", "method_chunk_detected"), F.when(t == "unknown", "unknown_block_type"),
    ))
    return x.withColumns({"token_count": n, "warnings": warnings, "chunk_id": chunk_hash(doc, "chunk", F.concat_ws(":", "order_index", "part_index", F.substring("content", 1, 80)))})


def chunk_hash(doc: str, name: str, of) -> object:
    return F.concat(F.col(doc).cast("string"), F.lit(f"_{name}_"), F.substring(F.sha1(of), 1, 10))


PARENTS = "heading_path array<string>, heading_level int, title string, part_index int, order_start int, order_end int, page_start int, page_end int, text string"


def _find_parents(of: dict[str, list]) -> tuple[list[int], dict[str, list]]:
    row, b = find_blocks(of)
    paths = [(r, *(p or [of["title"][r] or "Untitled"])) for r, p in zip(row, b["heading_path"])]
    edge = [i for i in range(len(row)) if not i or paths[i] != paths[i - 1]]
    n = np.array([count(x) for x in b["text"]], np.int64)
    rows: list[int] = []
    out: dict[str, list] = {f.split()[0]: [] for f in PARENTS.split(", ")}
    for lo, hi in zip(edge, [*edge[1:], len(row)]):
        for k, (i, j) in enumerate(budgets(n[lo:hi], None, SECTION_MOST)):
            i, j = lo + i, lo + j
            pages = [p for p in b["page"][i:j] if p is not None]
            rows.append(row[i])
            for name, v in (
                ("heading_path", list(paths[i][1:])), ("heading_level", b["level"][i] or len(paths[i]) - 1), ("title", paths[i][-1]), ("part_index", k), ("order_start", b["order_index"][i]), ("order_end", b["order_index"][j - 1]),
                ("page_start", min(pages, default=None)), ("page_end", max(pages, default=None)), ("text", "\n\n".join(x for x, kind in zip(b["text"][i:j], b["kind"][i:j]) if kind != "heading")),
            ):
                out[name].append(v)
    return rows, out


def section_chunks(documents: DataFrame, body: str, title: str, doc: str) -> DataFrame:
    """Parents of chunks: runs of blocks under one path, at most 3,000 tokens, cut at the edges of blocks. One pass, no shuffle."""
    x = expand(documents, {"text": body, "title": title}, [doc], PARENTS, _find_parents)
    return x.withColumn("section_id", chunk_hash(doc, "sec", F.concat(F.array_join("heading_path", " > "), F.lit(":"), F.col("order_start").cast("string"), F.lit(":"), F.col("part_index").cast("string"))))


def parent_of(atoms: DataFrame, parents: DataFrame, doc: str) -> DataFrame:
    """Atoms with the section they stand in: parents' ranges opened to the blocks they hold, an equi-join."""
    held = parents.select(doc, "section_id", F.explode(F.sequence("order_start", "order_end")).alias("order_index"))
    return atoms.join(held, [doc, "order_index"], "left").withColumnRenamed("section_id", "parent_section_id")


# -- links


def neighbours(chunks: DataFrame, doc: str, order: str, id_col: str) -> DataFrame:
    """Each chunk with the one before and after it in its document."""
    w = Window.partitionBy(doc).orderBy(order, id_col)
    return chunks.withColumns({"prev_id": F.lag(id_col).over(w), "next_id": F.lead(id_col).over(w)})


def same_section_links(chunks: DataFrame, keys: list[str], order: str, id_col: str, reach: int = 5) -> DataFrame:
    """(source, target) of chunks at most `reach` positions apart in a section: leads over a window, without a range join."""
    w = Window.partitionBy(*keys).orderBy(order, id_col)
    ahead = F.array(*[F.lead(id_col, i).over(w) for i in range(1, reach + 1)])
    x = chunks.select(F.col(id_col).alias("source"), ahead.alias("ahead"))
    return x.select("source", F.explode(F.filter("ahead", lambda a: a.isNotNull())).alias("target"))


def islands(df: DataFrame, doc: str, order: str, value: str) -> DataFrame:
    """A number that grows whenever the value changes in the document's order."""
    w = Window.partitionBy(doc).orderBy(order)
    change = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & F.lag(order).over(w).isNotNull(), 0).otherwise(1)
    return df.withColumn("__c", change).withColumn("island", F.sum("__c").over(w)).drop("__c")
