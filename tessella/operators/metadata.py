"""Titles, sources and departments of documents and their chunks, found anew or corrected, and what a correction would change.

All of it is expressions over a row; rule tables are parameters. A correction is a plan whose changes can be looked at (changes)
before it replaces a stored table (sources.ingest.replace).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import SPACE, squeeze
from tessella.operators.classify import restrict

#: What titles don't hold, heads of journals, names that aren't titles, folders that name no source, and the unknown label.
BAD_TITLE = r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffd\u25a0\u25a1\u25aa]"
JOURNAL_TITLES = r"(?i)中华.{0,12}杂志.{0,80}第\s*\d+\s*卷.{0,40}第\s*\d+\s*期|Chin\s+J\s+.{0,80}\bVol\.?\s*\d+.{0,40}\bNo\.?\s*\d+|\bVol\.?\s*\d+.{0,40}\bNo\.?\s*\d+|^\d+\s+年\s*\d+\s*月\s*第\s*\d+\s*卷\s*第\s*\d+\s*期"
ARTIFACTS = r"(?i)^(?:figures?|tables?(?:\s+\d.*)?|frequently asked questions|faq|coming soon|loading|position statement|resumen|whereas.*|measure scoring sheet|pdsa worksheet.*|prior authorization checklist|insurance verification|erratum.*)$"
GENERIC_FOLDERS = ("raw_pdf", "consensus", "pdfs", "documents", "pages")
ABSTRACT_BOUNDARY = r"(?i)摘要|提要|\babstract\b|\bsummary\b"
UNKNOWN = "未分类"


def _plain(x: Column) -> Column:
    """Full-width digits as plain ones."""
    return F.translate(F.coalesce(x, F.lit("")), "０１２３４５６７８９", "0123456789")


def _count(x: Column, of: str) -> Column:
    return F.length(F.regexp_replace(x, f"[^{of}]+", "")).cast("double")


def clean_title(x: Column) -> Column:
    """Without comments, bad characters and signs at both ends, at most 180 characters."""
    t = F.regexp_replace(F.regexp_replace(_plain(x), BAD_TITLE, ""), "<!--.*?-->", " ")
    return F.trim(F.substring(F.regexp_replace(squeeze(t), r"(?U)^[\W_]+|[\W_]+$", ""), 1, 180))


def title_score(x: Column) -> Column:
    """How much a text looks like a title: much of it letters, some Chinese, few signs, neither short nor long, no volume or number."""
    t = F.trim(_plain(x))
    seen = F.regexp_replace(t, SPACE, "")
    n = F.greatest(F.length(seen), F.lit(1)).cast("double")
    score = (
        _count(seen, r"\p{L}\p{Nd}") / n + F.least(_count(seen, "一-鿿"), F.lit(12.0)) * 0.03 - _count(seen, r"\p{C}") * 0.5 - _count(seen, r"!-/:-@\[-`{-~") / n * 0.5
        - F.when(F.length(t) < 6, 0.4).otherwise(0.0) - F.when(F.length(t) > 160, 0.2).otherwise(0.0) - F.when(t.rlike(r"(?iU)\b(vol|no|journal|杂志|第\d+卷|第\d+期)\b"), 0.15).otherwise(0.0)
    )
    return F.when(F.length(seen) == 0, -100.0).otherwise(F.round(score, 6))


def suspicious_title(x: Column) -> Column:
    t = F.trim(_plain(x))
    seen = F.regexp_replace(t, SPACE, "")
    n = F.greatest(F.length(seen), F.lit(1))
    return (F.length(t) < 4) | t.rlike(BAD_TITLE) | t.rlike(JOURNAL_TITLES) | (_count(seen, r"\p{L}\p{Nd}") / n < 0.25) | ((F.length(seen) > 30) & (_count(seen, r"!-/:-@\[-`{-~") / n > 0.45))


def title_of_file(path: Column) -> Column:
    name = F.element_at(F.split(F.coalesce(path, F.lit("")), r"[/\\]"), -1)
    return clean_title(F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z0-9]{1,5}$", ""), r"[_\-]+", " "))


def find_title(body: Column, path: Column, most: int = 12) -> Column:
    """The best of the first heading, the first lines and the file's name: of those that aren't suspicious if there are any."""
    text = F.coalesce(body, F.lit(""))
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("<!--"))
    heading = F.trim(F.regexp_extract(text, r"(?m)^#{1,6}[^\S\n]+(\S[^\r\n]*)", 1))
    given = F.slice(F.concat(F.filter(F.array(heading), lambda x: x != ""), F.transform(lines, lambda x: F.substring(x, 1, 220))), 1, most)
    cleaned = F.filter(F.transform(F.array_append(given, title_of_file(path)), clean_title), lambda x: x != "")
    ranked = F.transform(cleaned, lambda x, i: F.struct((~suspicious_title(x)).alias("ok"), title_score(x).alias("score"), (-i).alias("first"), x.alias("title")))
    return F.coalesce(F.array_max(ranked)["title"], F.lit(""))


def source_institution(path: Column, title: Column, text: Column, *, hints: dict[str, str], own: str | None = None, own_name: str = "", patterns: Sequence[tuple[str, Sequence[str]]] = ()) -> Column:
    """Who published a document: by a folder of its path, by a folder named ..._pdf, by a pattern (own) or words in its file's name, title and
    what stands before its abstract; those of a folder of consensus papers are left to hand."""
    m = F.create_map(*[x for k, v in hints.items() for x in (F.lit(k.lower()), F.lit(v))])
    parts = F.filter(F.split(F.lower(F.regexp_replace(F.coalesce(path, F.lit("")), r"\\", "/")), "/"), lambda p: ~p.isin(*GENERIC_FOLDERS))
    named = F.transform(parts, lambda p: F.coalesce(F.try_element_at(m, p), F.when(p.endswith("_pdf") & (F.length(p) > 4), F.substring(p, F.lit(1), F.length(p) - 4))))
    by_path = F.try_element_at(F.filter(named, lambda v: v.isNotNull()), F.lit(1))
    before = F.element_at(F.split(F.coalesce(text, F.lit("")), ABSTRACT_BOUNDARY, 2), 1)
    hay = F.concat_ws("\n", F.element_at(F.split(F.coalesce(path, F.lit("")), r"[/\\]"), -1), title, before)
    out = F.when(by_path.isNotNull(), by_path)
    if own:
        out = out.when(hay.rlike(own), own_name)
    out = out.when(F.coalesce(path, F.lit("")).rlike(r"(?i)(?:^|[/\\])consensus(?:[/\\]|$)"), "Unknown")
    for name, words in patterns:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.lower(hay).contains(w.lower())
        out = out.when(hit, name)
    return out.otherwise("Unknown")


def title_labels(title: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(labels, reason) by patterns of titles alone, in the rules' order."""
    t = F.trim(_plain(title))
    generic = (t == "") | t.rlike(ARTIFACTS)
    hits = F.array_distinct(F.array_compact(F.array(*[F.when(t.rlike(f"(?i){p}"), label) for label, p in rules])))
    labels = F.when(generic, F.array().cast("array<string>")).otherwise(hits)
    return F.struct(labels.alias("labels"), F.when(generic, "artifact_or_generic_title").when(F.size(hits) > 0, "title_rule").otherwise("no_precise_signal").alias("reason"))


def labels_of(joined: Column) -> Column:
    """A|B as a list, without blanks and repetitions."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(joined, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != ""))


def relabelled(own: Column, parent: Column, found: Column, force: bool = False) -> Column:
    """A part's labels: those it has if its document has them all; its document's first if it is unknown and the document isn't; else what is
    found in it, as far as its document has it."""
    if force:
        return restrict(found, parent)
    unknown = (F.array_join(own, "|") == UNKNOWN) & ~F.array_contains(parent, UNKNOWN)
    inside = (F.size(own) > 0) & (F.size(F.array_except(own, parent)) == 0)
    return F.when(unknown, F.slice(parent, 1, 1)).when(inside, own).otherwise(restrict(found, parent))


def changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, field, before, after) of what a correction would change; nothing is written."""
    x = old.select(key, *[F.col(c).cast("string").alias(f"__o{i}") for i, c in enumerate(columns)]).join(new.select(key, *[F.col(c).cast("string").alias(f"__n{i}") for i, c in enumerate(columns)]), key)
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"__o{i}").alias("before"), F.col(f"__n{i}").alias("after")) for i, c in enumerate(columns)])
    return x.select(key, F.explode(F.filter(each, lambda e: ~e["before"].eqNullSafe(e["after"]))).alias("e")).select(key, "e.*")


def change_report(found: DataFrame, key: str, examples: int = 8) -> tuple[DataFrame, DataFrame]:
    """Of changes: (field, n), and for each field its first examples by key, which each task limits before anything is shuffled."""
    w = Window.partitionBy("field").orderBy(key)
    return found.groupBy("field").agg(F.count("*").alias("n")), found.withColumn("example", F.row_number().over(w)).filter(F.col("example") <= examples)


def mean_confidence(lines: Column) -> Column:
    """The mean of a page's lines' confidences, null ones left out; null if there are none."""
    held = F.filter(lines, lambda x: x.isNotNull())
    return F.when(F.size(held) > 0, F.aggregate(held, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(held))
