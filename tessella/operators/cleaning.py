"""Cleaning of Markdown bodies, and how far their text layer can be trusted."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from itertools import accumulate, groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.lazy import lazy_udf
from tessella.functions.text import SPACE, signal_stats

#: What is taken out of lines and bodies.
DOI = r"(?i)(?:https?://)?(?:dx\.)?doi\.org/\S+|https?://(?:dx\.)?doi\.\S*|\bdoi\b\s*[:：]?\s*(?:10\.\d{4,9}/\S+)?"
EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
CONTACT = r"(?i)^\s*(?:Address\s+correspondence\s+to|Correspondence\s+to|Corresponding\s+author|For\s+correspondence\b|Contact\s*:).{0,300}$"
JOURNAL = r"(?i)(?:中华.{0,24}杂志.{0,120}(?:第\s*\d+\s*卷|Vol\.?\s*\d+).{0,80}(?:第\s*\d+\s*期|No\.?\s*\d+))|(?:(?:Chinese\s*Journal|Chin\s*J|中华).{0,120}(?:Vol\.?\s*\d+|No\.?\s*\d+))"
AUTHORS = r"(?i)(?:E[-￣\s]*mail|Email)\s*[:：]\s*\S+|(?:共同)?(?:通信|通讯|第一)作者\s*[:：][^。；;\n]{0,160}|(?:Co[-\s]*(?:first|corresponding)\s+author)\s*[:：][^.;\n]{0,180}"
ABSTRACT_MARK = r"(?i)【\s*(?:提要|摘要)\s*】|(?:摘要|提要|Abstract)\s*[:：]"
PII = r"(?i)\bpii\s*[:：]\s*\S+"
PAGE_LINE = r"(?im)^\s*<!--\s*page:\s*\d+\s*-->\s*$"
BAD_GLYPHS = "[�■□▪-]"
CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
FORM_WORD = r"(?i)\b(?:date|time|name|notes?|score|pain|headache|medication|yes|no)\b"


#: A line of nothing but Latin letters, digits and signs; what scanners make of punctuation; a heading of references.
SIGNS_LINE = r"^[\d\s!！?？|/\\.,;:：；()（）\-—_+=*'\"`~<>A-Za-z]{8,}$"
SCANNED_MARKS = {"ꎬ": "，", "ꎻ": "；", "ꎮ": "。", "￣": "-", "＠": "@"}
REFERENCE_HEADING = r"(?im)^(#{1,6}\s+)(references|bibliography|参考文献)\b"


def strip_inline_noise(line: Column) -> Column:
    """A contact line goes; addresses, DOIs, journal heads and notes on authors in a line become a blank, and what stands before a late mark
    of an abstract goes."""
    out = F.regexp_replace(line, CONTACT, "")
    for p in (JOURNAL, DOI, PII, EMAIL, AUTHORS):
        out = F.regexp_replace(out, p, " ")
    at = F.length(F.regexp_extract(out, rf"(?s)^(.*?)(?:{ABSTRACT_MARK})", 1))
    out = F.when(at > 80, F.substring(out, at + 1, F.length(out))).otherwise(out)
    return F.trim(F.regexp_replace(out, r"[ \t]{2,}", " "))


def _left(x: Column, of: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(F.regexp_replace(x, f"[^{of}]+", ""))


def low_signal(line: Column) -> Column:
    """A line, not a heading, with hardly any letters: of Latin letters and signs alone, or of 12 characters or more."""
    x = F.trim(line)
    letters, signs, seen = _left(x, r"\p{L}"), F.length(F.regexp_replace(x, r"(?U)[\p{L}\p{N}\s]+", "")), F.length(F.regexp_replace(x, SPACE, ""))
    few = F.when(x.rlike(SIGNS_LINE), (letters < 6) | (signs / F.length(x) > 0.25)).otherwise((seen >= 12) & (_left(x, r"\p{L}\p{N}") / seen < 0.25))
    return (x != "") & ~x.rlike(r"^#{1,6}\s+") & few


def bad_heading(line: Column) -> Column:
    """A heading without a letter, or of signs with few."""
    x = F.trim(line)
    title = F.trim(F.regexp_replace(x, r"^#{1,6}(?:\s+|$)", ""))
    letters = _left(title, r"\p{L}")
    return x.rlike(r"^#{1,6}(?:\s|$)") & ((letters == 0) | (title.rlike(SIGNS_LINE) & (letters < 6)))


def noisy_title(title: Column) -> Column:
    x = F.trim(F.coalesce(title, F.lit("")))
    letters, seen, signs = _left(x, r"\p{L}"), F.length(F.regexp_replace(x, SPACE, "")), F.length(F.regexp_replace(x, r"(?U)[\p{L}\p{N}\s]+", ""))
    return (x.rlike(SIGNS_LINE) & (letters < 8)) | ((seen >= 12) & (signs / seen > 0.35) & (letters < 12))


def fragmented_latin(body: Column) -> Column:
    """Whether Latin words have come apart: of 40 tokens or more many are single letters or numbers and few are words."""
    ts = F.regexp_extract_all(body, F.lit(r"[A-Za-z]+|\d+"), F.lit(0))
    n = F.size(ts)
    apart = F.size(F.filter(ts, lambda t: t.rlike(r"^(?:[A-Za-z]|\d+)$")))
    words = F.size(F.filter(ts, lambda t: (F.length(t) >= 4) & t.rlike("[aeiouAEIOU]")))
    return (n >= 40) & (apart / n > 0.45) & (words / n < 0.18)


def repeated_lines(df: DataFrame, id_col: str, body: str, least_pages: int = 3) -> DataFrame:
    """(id, line, pages): first and last three short lines of pages that stand on max(2, 30 %) of a document's pages."""
    pages = df.select(id_col, F.posexplode(F.split(F.col(body), r"<!--\s*page:\s*\d+\s*-->")).alias("page", "text"))
    lines = pages.withColumn("lines", F.filter(F.transform(F.split("text", "\n"), lambda f: F.trim(f)), lambda x: (x != "") & (F.length(x) < 140)))
    edge = F.array_distinct(F.concat(F.slice("lines", 1, 3), F.slice("lines", F.greatest(F.lit(1), F.size("lines") - 2), F.lit(3))))
    n = pages.groupBy(id_col).agg(F.count("*").alias("n_pages"))
    seen = lines.select(id_col, F.explode(edge).alias("line")).groupBy(id_col, "line").agg(F.count("*").alias("pages"))
    return seen.join(n, id_col).filter((F.col("n_pages") >= least_pages) & (F.col("pages") >= F.greatest(F.lit(2), F.ceil(F.col("n_pages") * 0.3)))).select(id_col, "line", "pages")


def assess(df: DataFrame, body: str) -> DataFrame:
    """df with quality, flags, signal_ratio and visible of a cleaned body. The text without white space is exploded from an array of
    one, so that it is made once for a row; what is counted in it is shared by generated code."""
    x = df.withColumn("__t", F.explode(F.array(F.regexp_replace(F.coalesce(body, F.lit("")), SPACE, ""))))
    t = F.coalesce(F.col(body), F.lit(""))
    # made once for a row: in conditions the optimizer would make what is shared anew
    x = x.withColumn("__s", F.explode(F.array(signal_stats(body, F.col("__t")))))
    s = F.col("__s")
    f = {"blanks": F.regexp_count(t, F.lit("_{3,}")), "words": F.regexp_count(t, F.lit(FORM_WORD)), "under": F.length(F.regexp_replace("__t", "[^_]+", ""))}
    under = f["under"] / F.greatest(F.lit(1), s["visible"]).cast("double")
    x = x.withColumn("__form", F.explode(F.array(F.struct(F.when(t.contains("___"), f["blanks"]).otherwise(0).alias("blanks"), F.when(t.contains("___"), f["words"]).otherwise(0).alias("words"), under.alias("under")))))
    f = F.col("__form")
    under = f["under"]
    form = ((f["blanks"] >= 5) & (f["words"] >= 3)) | ((f["blanks"] >= 12) & (under > 0.12))
    garbled = (s["visible"] >= 1000) & ~form & ((s["weird_ratio"] > 0.12) | ((s["signal_ratio"] < 0.55) & (s["punctuation_ratio"] > 0.45)) | ((s["signal_ratio"] < 0.6) & (s["cjk_ratio"] < 0.05) & (s["mojibake_marker_ratio"] > 0.008)))
    # asked in this order, so that only bodies that can fail are taken apart
    failed = F.when(garbled, True).when(form | (s["cjk"] > 0) | (s["visible"] <= 300), False).when(s["signal_ratio"] < 0.6, True).otherwise(fragmented_latin(t))
    # few lines need the measures of low_signal; made once, as more than one flag asks for it
    lines = F.filter(F.split(t, "\n"), lambda x: F.when(F.ltrim(x).startswith("#"), bad_heading(x)).when(F.length(x) >= 8, low_signal(x)).otherwise(False))
    x = x.withColumn("__noisy", F.explode(F.array(F.size(lines))))
    noisy = F.col("__noisy")
    flags = F.array_compact(
        F.array(
            F.when(s["visible"] < 300, "very_short_text"),
            F.when((s["signal_ratio"] < 0.45) & ~form, "low_text_signal"),
            F.when(~form & ((noisy >= 2) | ((s["visible"] < 500) & (noisy >= 1))), "noisy_ocr_lines"),
            F.when(failed & ~garbled, "likely_ocr_failure"),
            F.when(garbled, "pdf_text_mojibake"),
            F.when(garbled, "likely_ocr_failure"),
            F.when(t.rlike(JOURNAL), "journal_header_residue"),
            F.when(F.lower(t).contains("doi") & t.rlike(DOI), "doi_residue"),
            F.when(t.contains("@") & t.rlike(EMAIL), "email_residue"),
            F.when(t.contains("<!--") & t.rlike(PAGE_LINE), "page_marker_residue"),
            F.when(t.rlike(BAD_GLYPHS), "bad_glyph_residue"),
        )
    )
    x = x.withColumn("flags", flags)
    poor = F.arrays_overlap("flags", F.array(*[F.lit(v) for v in ("low_text_signal", "likely_ocr_failure", "noisy_ocr_lines")]))
    return x.withColumns({"quality": F.when(poor, "poor").when(F.size("flags") > 0, "warning").otherwise("ok"), "signal_ratio": F.round(s["signal_ratio"], 3), "visible": s["visible"]}).drop("__t", "__noisy", "__s", "__form")


#: What goes from a line, what it becomes, and what the line must hold, in lower case, for that to be tried.
_INLINE = [(re.compile(p.replace("(?i)", ""), re.I), to, marks) for p, to, marks in ((CONTACT, "", ("correspond", "contact")), (JOURNAL, " ", ("中华", "chin")), (DOI, " ", ("doi",)), (PII, " ", ("pii",)), (EMAIL, " ", ("@",)), (AUTHORS, " ", ("mail", "作者", "author")))]
_ABSTRACT, _PAGE, _SIGNS, _HEADING, _REFERENCES = (re.compile(p) for p in (ABSTRACT_MARK, PAGE_LINE, SIGNS_LINE, r"#{1,6}(?:\s+|$)", REFERENCE_HEADING))
_LETTERS, _SIGNAL, _SPACED = re.compile(r"[^\W\d_]"), re.compile(r"[^\W_]"), re.compile(r"(?<![A-Za-z0-9])(?:[A-Za-z0-9]\s+){3,}[A-Za-z0-9](?![A-Za-z0-9])")
_CJK, _ENDS, _LISTED = re.compile(r"[一-鿿぀-ヿ]"), re.compile(r"[。！？!?；;：:]$"), re.compile(r"(?:[-*+]|\d+[.)、])\s+")
_GONE = re.compile(f"{BAD_GLYPHS}|{CONTROLS}")


def _closed(m: re.Match[str]) -> str:
    """A word that has come apart; numbers in a row stay apart."""
    word = "".join(m[0].split())
    return word if len(_LETTERS.findall(word)) >= 4 else m[0]


def _inline(line: str) -> str:
    low = line.lower()
    for p, to, marks in _INLINE:
        if any(m in low for m in marks):
            line = p.sub(to, line)
    if len(line) > 80 and (m := _ABSTRACT.search(line)) and m.start() > 80:
        line = line[m.start() :]
    return " ".join(line.split())


def _dropped(line: str) -> bool:
    """Headings without letters, and lines with hardly any."""
    if h := _HEADING.match(line):
        title = line[h.end() :].strip()
        n = len(_LETTERS.findall(title))
        return not n or n < 6 and bool(_SIGNS.match(title))
    if _SIGNS.match(line):
        return len(_LETTERS.findall(line)) < 6 or sum(not (c.isalnum() or c.isspace()) for c in line) > 0.25 * len(line)
    seen = len(line) - line.count(" ")
    return seen >= 12 and len(_SIGNAL.findall(line)) < 0.25 * seen


def repeated_in(lines: list[str]) -> set[str]:
    """Short first and last lines of pages that stand on many pages of one body: see repeated_lines."""
    starts = [i for i, x in enumerate(lines) if _PAGE.match(x)]
    edges = sorted({0, *starts, len(lines)})
    pages = [[y for y in map(str.strip, lines[a:b]) if y and not _PAGE.match(y)] for a, b in zip(edges, edges[1:])]
    if len(pages) < 3:
        return set()
    n = Counter(x for p in pages for x in {*p[:3], *p[-3:]} if len(x) < 140)
    return {x for x, k in n.items() if k >= max(2, int(len(pages) * 0.3 + 0.999))}


def _assembled(lines: list[str]) -> str:
    """Lines of Chinese prose that the page broke, joined; headings of references marked."""
    prose = [len(_CJK.findall(x)) >= 3 and not _HEADING.match(x) and not _LISTED.match(x) for x in lines]
    breaks = accumulate(not (i and prose[i] and prose[i - 1] and not _ENDS.search(lines[i - 1])) for i in range(len(lines)))
    joined = ("".join(x for x, _ in g) for _, g in groupby(zip(lines, breaks), key=lambda x: x[1]))
    return _REFERENCES.sub(r"\1\2\n<!-- reference_section: true -->", "\n".join(joined))


def _visible(text: str) -> int:
    return sum(map(len, text.split()))


def clean_body(text: str | None) -> str | None:
    """A body without page marks, running headers, control characters, bad glyphs, inline noise, bad headings and lines without signal, with
    broken words and lines joined; numbers in a row stay as they are. If less than 35 % of a long body would be left, lines without
    signal stay. Null stays null."""
    if text is None:
        return None
    body = unicodedata.normalize("NFKC", text.replace("\r\n", "\n").replace("\r", "\n"))
    for bad, good in SCANNED_MARKS.items():
        body = body.replace(bad, good)
    body = _GONE.sub("", "\n".join(_SPACED.sub(_closed, x) for x in body.split("\n")))
    body = re.sub(r"(?<=[a-z,;])\n(?=[a-z(])", " ", re.sub(r"(?<=[A-Za-z])-\n(?=[A-Za-z])", "", body))
    lines = body.split("\n")
    repeated = repeated_in(lines)
    kept = [_inline(x) for x in lines if not _PAGE.match(x) and x.strip() not in repeated]
    new = _assembled([x for x in kept if not _dropped(x)])
    seen = _visible(_PAGE_ALL.sub("", body))
    if seen >= 1000 and (left := _visible(new)) < max(300, 0.35 * seen) and (left < 300 or left / seen < 0.35):
        new = _assembled(kept)
    return re.sub(r"\n{3,}", "\n\n", new).strip()


_PAGE_ALL = re.compile(PAGE_LINE)


@lazy_udf("string")
def cleaned(x: pd.Series) -> pd.Series:
    return x.map(clean_body)


def page_report(pages: DataFrame, id_col: str, low_chars: int = 80, image_ratio: float = 0.45, scanned: float = 0.6) -> DataFrame:
    """Of page statistics (chars, image_area_ratio): whether a file is scanned and needs text recognition."""
    low = F.col("chars") < low_chars
    a = pages.groupBy(id_col).agg(F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.count_if(low).alias("low_pages"), F.count_if(low & (F.col("image_area_ratio") >= image_ratio)).alias("image_pages"))
    is_scanned = F.col("image_pages") / F.col("pages") >= scanned
    needs = is_scanned | (F.col("low_pages") / F.col("pages") >= scanned)
    return a.withColumns({"is_scanned": is_scanned, "needs_ocr": needs, "quality": F.when(needs, "poor").when(F.col("low_pages") > 0, "warning").otherwise("ok")})


def audit(df: DataFrame, pdf_chars: str, md_chars: str, pdf_pages: str, md_pages: str, per_page: int = 80, least: float = 0.35) -> DataFrame:
    """How complete a Markdown body is against its file."""
    ratio = F.when(F.col(pdf_chars) > 0, F.col(md_chars) / F.col(pdf_chars))
    needs = F.col(pdf_chars) < F.col(pdf_pages) * per_page
    thin = (F.col(pdf_chars) >= 1000) & (ratio < least)
    off = (F.col(md_pages) > 0) & (F.abs(F.col(pdf_pages) - F.col(md_pages)) > F.greatest(F.lit(2.0), F.col(pdf_pages) * 0.1))
    return df.withColumns({"ratio": F.round(ratio, 3), "needs_ocr": needs, "low_completeness": thin, "page_mismatch": off, "status": F.when(needs, "needs_ocr").when(thin, "low_completeness").when(off, "page_mismatch").otherwise("ok")})
