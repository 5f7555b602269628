"""Text as columns: tokens, space, phrases, overlap and character statistics, all inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a token, and as a query term (a whole run of Chinese characters is one term).
TOKEN = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)?|[一-鿿]"
TERM = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)?|[一-鿿]+"
SPACE = r"(?U)\s+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(x: Column | str) -> Column:
    """Lower-cased search tokens; null gives an empty array."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(x), F.lit(""))), F.lit(TOKEN), F.lit(0))


def token_count(x: Column | str) -> Column:
    return F.coalesce(F.regexp_count(_c(x), F.lit(TOKEN)), F.lit(0))


def squeeze(x: Column | str) -> Column:
    """Each run of white space of any kind to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), SPACE, " "))


def clip(x: Column | str, limit: int) -> Column:
    """Squeezed and cut at limit with "..." appended; a limit of 0 or less gives an empty text."""
    s = squeeze(x)
    if limit <= 0:
        return F.lit("")
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.rtrim(F.substring(s, 1, limit)), F.lit("...")))


def compact(x: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(_c(x), F.lit("")), SPACE, ""))


def query_terms(query: str) -> list[str]:
    """Distinct terms of a query in order, for the driver."""
    return list(dict.fromkeys(re.findall(TERM, (query or "").lower())))


def terms(x: Column | str) -> Column:
    """query_terms as a column, for many queries."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(_c(x), F.lit(""))), F.lit(TERM), F.lit(0)))


def contains_phrase(x: Column | str, query: str) -> Column:
    """Whether the text holds the query as it is, or both without any space; an empty query is in no text."""
    q = (query or "").strip().lower()
    if not q:
        return F.lit(False)
    return F.lower(F.coalesce(_c(x), F.lit(""))).contains(q) | compact(x).contains(re.sub(r"\s+", "", q))


def contains_term(x: Column | str, of: list[str]) -> Column:
    out = F.lit(False)
    low, squeezed = F.lower(F.coalesce(_c(x), F.lit(""))), compact(x)
    for t in of:
        out = out | low.contains(t) | squeezed.contains(re.sub(r"\s+", "", t))
    return out


def term_overlap(x: Column | str, of: list[str]) -> Column:
    """Share of the terms that occur in the text."""
    if not of:
        return F.lit(0.0)
    low, squeezed = F.lower(F.coalesce(_c(x), F.lit(""))), compact(x)
    hits = [F.when(low.contains(t) | squeezed.contains(re.sub(r"\s+", "", t)), 1).otherwise(0) for t in of]
    return sum(hits[1:], hits[0]) / F.lit(float(len(of)))


def token_overlap(of: Column, in_tokens: Column) -> Column:
    """Share of an array of terms that are tokens of the text."""
    return F.when(F.size(of) > 0, F.size(F.array_intersect(of, in_tokens)) / F.size(of)).otherwise(F.lit(0.0))


def sort_by_overlap(items: Column, of: list[str]) -> Column:
    """An array of struct(text, priority) by falling overlap, then falling priority."""
    scored = F.transform(items, lambda i: F.struct((-term_overlap(i["text"], of)).alias("o"), (-i["priority"]).alias("p"), i.alias("i")))
    return F.transform(F.array_sort(scored), lambda s: s["i"])


def dedupe_lines(lines: Column, most: int) -> Column:
    """The first of lines that differ only in case, in order, at most so many."""
    seen = F.aggregate(
        lines,
        F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.when(
            F.array_contains(acc["keys"], F.lower(x)) | (F.length(F.trim(x)) == 0), acc
        ).otherwise(F.struct(F.array_append(acc["keys"], F.lower(x)).alias("keys"), F.array_append(acc["out"], x).alias("out"))),
    )
    return F.slice(seen["out"], 1, most)


def flags(x: Column | str) -> Column:
    """A list of flags with changing separators, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(_c(x), F.lit("")), r"[,;]\s*"), lambda f: F.trim(f)), lambda f: f != "")


def add_flag(x: Column | str, flag: str) -> Column:
    return F.array_join(F.array_union(flags(x), F.array(F.lit(flag))), ",")


def field_text(columns: list[str], name: str) -> Column:
    """A record's text: the field of that name where there is one that isn't empty, else its content."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in (name, "content") if c in columns], F.lit(""))


#: Signs that count as readable beside letters and numbers.
READABLE = r"，。；：、“”‘’（）《》.,;:!?()/%\-"


def readable_ratio(x: Column | str) -> Column:
    """Share of letters, numbers and usual signs in what isn't white space; 0 for an empty text."""
    t = F.regexp_replace(F.coalesce(_c(x), F.lit("")), SPACE, "")
    return F.when(F.length(t) == 0, 0.0).otherwise(_kept(t, r"\p{L}\p{N}" + READABLE) / F.length(t))


def weak(x: Column | str, least: int) -> Column:
    return F.length(squeeze(x)) < least


#: Classes of characters for the statistics of a text layer.
CJK = "一-鿿぀-ヿ"
WEIRD = "\\x7f-\\x9f\\u00ac\\u00ae\\u00af\\u00b1\\u00b4-\\u00b6\\u00b8-\\u00be\\u0370-\\u03ff"
MARKERS = "摇揖铱鄄臆茁冶誗ꎬꎻꎮ"
LATIN_TOKEN = r"[A-Za-z]+|\d+"


def _kept(x: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(x, f"[^{chars}]+", ""))


def signal_stats(x: Column | str, without_space: Column | None = None) -> Column:
    """Counts and ratios of visible, signal, CJK, weird, marker and punctuation characters as a struct. Signal is what
    the JVM takes for a letter or number of any script. without_space: the text without white space, where it is known."""
    plain = F.coalesce(_c(x), F.lit(""))
    t = without_space if without_space is not None else F.regexp_replace(plain, SPACE, "")

    def counts(t: Column) -> Column:
        return F.struct(F.length(t).alias("visible"), _kept(t, "\\p{L}\\p{N}" + CJK).alias("signal"), _kept(t, CJK).alias("cjk"), _kept(t, WEIRD).alias("weird"), _kept(t, MARKERS).alias("marks"), F.regexp_count(plain, F.lit(LATIN_TOKEN)).alias("latin"))

    def ratios(c: Column) -> Column:
        total = F.greatest(c["visible"], F.lit(1)).cast("double")
        return F.struct(
            c["visible"].alias("visible"), c["signal"].alias("signal"), c["cjk"].alias("cjk"), (c["signal"] / total).alias("signal_ratio"), (c["cjk"] / total).alias("cjk_ratio"), (c["latin"] / total).alias("latin_token_ratio"),
            (c["weird"] / total).alias("weird_ratio"), (c["marks"] / total).alias("mojibake_marker_ratio"), ((c["visible"] - c["signal"]) / total).alias("punctuation_ratio"),
        )

    # a transform of an array of one binds what it is given, so that each text is read once for each class of characters
    return F.transform(F.transform(F.array(t), counts), ratios)[0]


def sanitize(x: Column | str, limit: int) -> Column:
    """For logs: a long text ends with how much was left out."""
    c = _c(x)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, limit), F.format_string("...[truncated %d chars]", F.length(c) - limit)))


def hide_secrets(m: Column, keys: tuple[str, ...] = ("password", "token", "secret", "api_key", "dsn")) -> Column:
    """Values of a map's secret keys as ***."""
    return F.transform_values(m, lambda k, v: F.when(F.lower(k).rlike("|".join(keys)), F.lit("***")).otherwise(v))


def field_template(*fields: tuple[str, Column]) -> Column:
    """[Label] and value of each field that isn't empty, with a blank line between."""
    return F.concat_ws("\n\n", *[F.when(F.length(F.trim(v)) > 0, F.concat(F.lit(f"[{label}]\n"), v)) for label, v in fields])


def embedding_text(path: Column, chunk_type: Column, content: Column) -> Column:
    return F.concat(F.lit("[GUIDELINE SECTION]\n"), F.array_join(path, " > "), F.lit("\n\n[CHUNK TYPE]\n"), chunk_type, F.lit("\n\n[CONTENT]\n"), content)


def retrieval_text(title: Column, path: Column, chunk_type: Column, content: Column) -> Column:
    """Title, path, type and content on a line each, without the empty ones."""
    def some(c: Column) -> Column:
        return F.when(F.length(F.trim(c)) > 0, c)

    return F.concat_ws("\n", some(title), some(F.array_join(path, " > ")), F.when(F.length(chunk_type) > 0, F.concat(F.lit("chunk_type: "), chunk_type)), some(content))


def join_tokens(ts: Column) -> Column:
    """Tokens to text, without blanks before closing and after opening punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.array_join(ts, " "), r"\s+([,.;:!?，。；：！？%)\]])", "$1"), r"([(\[])\s+", "$1"))


def expand_query(query: str, synonyms: dict[str, list[str]] | None = None, suffixes: tuple[str, ...] = ("guideline", "recommendation", "treatment guideline"), most: int = 6, bilingual: dict[str, str] | None = None) -> list[str]:
    """The query, its terms in the other language, its variants by synonyms and with suffixes; distinct, the first `most`."""
    query = " ".join((query or "").split())
    other = [v for k, v in (bilingual or {}).items() if k in query.lower()]
    out = [query, " ".join(other), " ".join([*other, "推荐", "指南"]) if other else ""]
    for term, others in (synonyms or {}).items():
        if term.lower() in query.lower():
            out += [re.sub(re.escape(term), o.replace("\\", r"\\"), query, flags=re.I) for o in others]
    out += [f"{query} {s}" for s in suffixes] if query else []
    return list({x.lower(): x for x in reversed(out) if x.strip()}.values())[::-1][:most]
