"""Cards and views: what a document is about, in a few fields, and one row for each way to look at it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import clip, dedupe_lines, squeeze
from tessella.operators.metadata import UNKNOWN, labels_of

#: Views and their priorities, limits of texts.
PRIORITIES = {"title_abstract": 1.0, "scope_population": 1.15, "recommendation_summary": 1.35, "pico_questions": 1.2, "heading_tree": 0.8, "table_titles": 1.05, "conclusion": 0.85}
CARD_CHARS, VIEW_CHARS = 12_000, 6_000
KEPT = {"recommendation": 18, "pico": 14, "evidence": 12, "scope_population": 10, "table": 18}
#: Signals of lines.
SIGNALS = {
    "recommendation": r"(?i)(\b(should|recommend|recommended|suggest|offer|avoid|consider)\b|推荐|建议|应)",
    "pico": r"(?i)(\bPICO\b|clinical question|key question|临床问题|关键问题)",
    "evidence": r"(?i)(evidence|certainty|systematic review|证据|系统评价)",
    "scope_population": r"(?i)(scope|target population|applicability|适用|目标人群)",
    "table": r"(?i)^\s*(\||(?:table|fig(?:ure)?)\s*\d|表\s*\d|图\s*\d)",
}


def candidate_lines(body: Column, most: int | None = None) -> Column:
    """Useful lines: squeezed, of 12 characters or more, not headings or comments. most: of so many first lines of a body; of all by default."""
    all_ = F.split(F.coalesce(body, F.lit("")), r"\r?\n")
    lines = F.transform(F.slice(all_, 1, most) if most else all_, squeeze)
    return F.filter(lines, lambda x: (F.length(x) >= 12) & ~x.startswith("#") & ~x.startswith("<!--"))


def matching_lines(body: Column, kind: str) -> Column:
    return dedupe_lines(F.filter(candidate_lines(body), lambda x: x.rlike(SIGNALS[kind])), KEPT[kind])


def abstract(body: Column, most: int = 1200) -> Column:
    """The first lines that are neither headings nor comments nor table rows."""
    return clip(F.array_join(F.slice(F.filter(candidate_lines(body), lambda x: ~x.startswith("|")), 1, 8), " "), most)


def heading_tree(body: Column, most: int = 40) -> Column:
    return F.array_join(F.slice(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"(?m)^#{1,6}\s+(.+?)\s*$"), F.lit(1)), 1, most), "\n")


def cards(df: DataFrame, body: str = "content_md") -> DataFrame:
    """doc_id and metadata with the fields and the text of the card. One pass over the bodies, no shuffle."""
    b = F.col(body)
    fields = {k: F.array_join(matching_lines(b, k), "\n") for k in KEPT}
    x = df.withColumns({**{f"f_{k}": v for k, v in fields.items()}, "f_heading_tree": heading_tree(b), "f_abstract": F.coalesce(F.nullif(squeeze("abstract"), F.lit("")), abstract(b))})
    text = clip(F.concat_ws("\n", "title", "f_abstract", "f_scope_population", "f_recommendation", "f_pico", "f_evidence", "f_table", "f_heading_tree"), CARD_CHARS)
    return x.withColumn("card_text", text)


def views(cards_: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A row for each view with text."""
    texts = {
        "title_abstract": F.concat_ws("\n", "title", "f_abstract"), "scope_population": F.col("f_scope_population"), "recommendation_summary": F.col("f_recommendation"),
        "pico_questions": F.col("f_pico"), "heading_tree": F.col("f_heading_tree"), "table_titles": F.col("f_table"), "conclusion": F.col("f_evidence"),
    }
    each = F.array(*[F.struct(F.lit(k).alias("view_type"), F.lit(PRIORITIES[k]).alias("priority"), clip(v, VIEW_CHARS).alias("text")) for k, v in texts.items()])
    kept = [c for c in VIEW_FIELDS[4:] + ("clinical_department",) if c in cards_.columns and c not in ("text", doc)]
    x = cards_.select(doc, *kept, F.explode(each).alias("v")).select(doc, *kept, "v.*").filter("text != ''")
    return x.withColumn("view_id", F.concat_ws("__", F.col(doc), "view_type"))


#: The fields of artifacts in their order.
CARD_FIELDS = ("doc_id", "title", "publication_date", "source_institution", "clinical_departments", "document_kind", "card_text")
VIEW_FIELDS = ("view_id", "doc_id", "view_type", "priority", "title", "text", "publication_date", "source_institution", "clinical_departments", "document_kind")
CHUNK_FIELDS = ("chunk_id", "doc_id", "title", "publication_date", "source_institution", "clinical_departments", "document_kind", "section_path", "chunk_index", "content", "retrieval_text", "chunk_type", "token_count", "retrieval_key", "is_background", "is_reference_section")


def contract(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The fixed fields of an artifact, missing ones as null; the list of departments comes from the joined ones, and is never empty."""
    none = F.array().cast("array<string>")
    own = F.col("clinical_departments") if "clinical_departments" in df.columns else labels_of(F.col("clinical_department")) if "clinical_department" in df.columns else none
    departments = F.when(F.size(F.coalesce(own, none)) > 0, own).otherwise(F.array(F.lit(UNKNOWN)))
    return df.select(*[departments.alias(f) if f == "clinical_departments" else F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields])
