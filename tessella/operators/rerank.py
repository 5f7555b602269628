"""Re-ranking of candidates by rules or by a pluggable scorer, and the penalties of text quality."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.records import recency_boost, truthy, year
from tessella.functions.text import clip, contains_phrase, contains_term, flags, query_terms, term_overlap
from tessella.operators import fusion
from tessella.operators.fusion import minmax

#: Statuses, flags and penalties.
OCR_UNRESOLVED = ("needed_unavailable", "needed_not_applied", "needed_but_disabled", "failed")
OCR_REVIEW = ("applied_needs_review",)
RISK_FLAGS = ("likely_ocr_failure", "low_text_signal", "noisy_ocr_lines", "pdf_text_mojibake")
GUIDE = r"(?i)(guideline|guidelines|consensus|recommendations?|指南|共识)"
TYPE_BOOST = {"recommendation": 0.18, "key_message": 0.14, "pico": 0.12, "algorithm": 0.10, "evidence": 0.06, "table": 0.05}
#: Of the BM25 service, for fusion.boosted.
SERVICE_BOOST = {"recommendation_candidate": 1.3, "evidence_candidate": 1.2, "table_row": 1.2, "rationale_candidate": 1.1, "table_parent": 1.05, "note": 1.0, "unknown": 0.7, "background": 0.6, "method": 0.4, "reference": 0.1}


def _low(c: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))))


def quality_multiplier(columns: Sequence[str] = ()) -> Column:
    """1 less the penalties of a card's quality columns, which are at most 0.55 together. columns: of the table, which need not hold the text
    quality of the source file; without it that penalty doesn't arise."""
    source = _low("source_pdf_text_quality") if "source_pdf_text_quality" in columns else F.lit("")
    q, p, s = _low("cleaning_quality"), _low("pdf_text_quality"), _low("ocr_status")
    f = flags(F.lower("cleaning_flags"))
    total = (
        F.when(q == "poor", 0.28).when(q == "warning", 0.08).otherwise(0.0)
        + F.when(p == "poor", 0.24).when(p == "warning", 0.08).otherwise(0.0)
        + F.when(truthy("pdf_needs_ocr"), 0.18).otherwise(0.0)
        + F.when(s.isin(*OCR_UNRESOLVED), 0.24).when(s.isin(*OCR_REVIEW), 0.14).otherwise(0.0)
        + F.when((s == "") & (source == "poor") & truthy("source_pdf_needs_ocr"), 0.14).otherwise(0.0)
        + F.when(F.arrays_overlap(f, F.array(*[F.lit(x) for x in RISK_FLAGS])), 0.18).otherwise(0.0)
        + F.when(F.array_contains(f, "noisy_ocr_title"), 0.10).otherwise(0.0)
    )
    return F.round(F.lit(1.0) - F.least(F.lit(0.55), total), 4)


def rule_documents(df: DataFrame, query: str, k: int, *, recency: bool = False, quality: Column | None = None) -> DataFrame:
    """df: doc_id, title, card_text, view_text, chunk_text, channels, publication_date, score."""
    terms = query_terms(query)
    boost = (
        F.when(contains_term("title", terms), 0.20).otherwise(0.0)
        + F.when(contains_phrase("title", query), 0.35).otherwise(0.0)
        + F.when(contains_term("card_text", terms), 0.12).otherwise(0.0)
        + F.when(contains_term("view_text", terms), 0.12).otherwise(0.0)
        + F.when(contains_term("chunk_text", terms), 0.10).otherwise(0.0)
        + F.when(F.col("channels") >= 3, 0.12).otherwise(0.0)
        + F.when(F.coalesce(F.col("title").rlike(GUIDE), F.lit(False)), 0.08).otherwise(0.0)
    )
    if recency:
        boost = boost + recency_boost("publication_date")
    out = df.withColumns({"base_score": F.col("score"), "boost": F.round(boost, 6), "score": F.round(F.col("score") * (F.lit(1.0) + boost) * (quality if quality is not None else F.lit(1.0)), 6)})
    return out.orderBy(F.desc("score"), F.desc(F.coalesce(year("publication_date"), F.lit(0))), "doc_id").limit(k)


def rule_chunks(df: DataFrame, query: str, k: int | None) -> DataFrame:
    """df: chunk_id, title, section_path, content, chunk_type, is_reference_section, token_count, score."""
    terms = query_terms(query)
    path = F.array_join(F.coalesce("section_path", F.array().cast("array<string>")), " > ")
    types = F.create_map(*[x for t, v in TYPE_BOOST.items() for x in (F.lit(t), F.lit(v))])
    boost = (
        F.when(contains_phrase("content", query), 0.36).otherwise(0.0)
        + F.when(contains_term("content", terms), F.least(F.lit(0.26), F.lit(0.08) + term_overlap("content", terms) * F.lit(0.22))).otherwise(0.0)
        + F.when(contains_term(path, terms), 0.12).otherwise(0.0)
        + F.when(contains_term("title", terms), 0.08).otherwise(0.0)
        + F.coalesce(F.try_element_at(types, F.coalesce("chunk_type", F.lit(""))), F.lit(0.0))
    )
    penalty = F.when(F.coalesce("is_reference_section", F.lit(False)), 0.75).otherwise(0.0) + F.when(path.rlike(r"(?i)(references?|bibliography|参考文献)"), 0.35).otherwise(0.0)
    s = F.col("score") * (F.lit(1.0) + boost) * F.greatest(F.lit(0.05), F.lit(1.0) - F.least(F.lit(0.9), penalty))
    out = df.withColumns({"base_score": F.col("score"), "score": F.round(s, 6)}).orderBy(F.desc("score"), F.desc(F.coalesce("token_count", F.lit(0))), "chunk_id")
    return out.limit(k) if k else out


Scorer = Callable[[str, list[str]], list[float]]
Reranker = Callable[[DataFrame, str, int], DataFrame]
#: Weights of the model's, the fused and the rules' score.
DOCUMENT_WEIGHTS, CHUNK_WEIGHTS = (0.86, 0.14, 0.0), (0.84, 0.10, 0.06)


def model_scores(df: DataFrame, query: str, text: str | Column, scorer: Scorer, name: str = "model_score") -> DataFrame:
    """A column of scores by a scorer of (query, texts), batch by batch; null, with the reason in `model_error`, where the scorer fails."""

    @F.pandas_udf("score double, error string")
    def score(x: pd.Series) -> pd.DataFrame:
        try:
            got = [float(v) for v in scorer(query, x.fillna("").tolist())]
            if len(got) != len(x):
                raise ValueError(f"{len(got)} scores for {len(x)} texts")
            return pd.DataFrame({"score": got, "error": [None] * len(x)})
        except Exception as e:  # noqa: BLE001 - a service may fail in any way, and the rules then stand
            return pd.DataFrame({"score": [None] * len(x), "error": [str(e)[:500]] * len(x)}).astype({"score": "float64"})

    x = df.withColumn("__s", score(text))
    return x.withColumns({name: F.when(F.isnan("__s.score"), None).otherwise(F.col("__s.score")), "model_error": F.col("__s.error")}).drop("__s")


def document_text(columns: Sequence[str]) -> Column:
    """What a model reads of a document, of the columns that there are."""

    def of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in columns else F.lit("")

    parts = [F.concat(F.lit(f"{label}: "), clip(of(c), n) if n else of(c)) for label, c, n in (("Title", "title", 0), ("Abstract", "abstract", 900), ("Source", "source_institution", 0), ("Department", "clinical_department", 0), ("Publication date", "publication_date", 0))]
    extra = [F.when(of(c) != "", F.concat(F.lit(label), clip(of(c), n))) for label, c, n in (("Document card: ", "card_text", 1400), ("Matched views:\n", "view_text", 2800), ("Matched chunks:\n", "chunk_text", 3500))]
    return F.concat_ws("\n\n", *parts, *extra)


def chunk_text() -> Column:
    path = F.array_join(F.coalesce("section_path", F.array().cast("array<string>")), " > ")
    parts = [("Title", F.col("title")), ("Source", F.col("source_institution")), ("Department", F.col("clinical_department")), ("Publication date", F.col("publication_date")), ("Section", path), ("Chunk type", F.col("chunk_type")), ("Content", clip("content", 1500))]
    return F.concat_ws("\n\n", *[F.concat(F.lit(f"{n}: "), F.coalesce(c, F.lit(""))) for n, c in parts])


def blend(df: DataFrame, weights: tuple[float, float, float], order: Sequence[Column], k: int, quality: Column | None = None) -> DataFrame:
    """Model, base and rule scores (model_score, base_score, score), each brought to 0..1 over the candidates, by weight. If the model
    failed for any candidate, the rules' order of all stands, and `reranker` says so."""
    failed = F.broadcast(df.agg(F.coalesce(F.bool_or(F.col("model_score").isNull()), F.lit(False)).alias("__failed")))
    x = df
    for c, name in (("model_score", "__m"), ("base_score", "__b"), ("score", "__r")):
        x = minmax(x, c, name, equal="one")
    s = sum((F.lit(w) * F.col(c) for w, c in zip(weights, ("__m", "__b", "__r")) if w), F.lit(0.0)) * (quality if quality is not None else F.lit(1.0))
    x = x.crossJoin(failed).withColumns({"reranker": F.when(F.col("__failed"), "rules, as the model failed").otherwise("model"), "score": F.when(F.col("__failed"), F.col("score")).otherwise(F.round(s, 6))})
    return x.drop("__m", "__b", "__r", "__failed").orderBy(*order).limit(k)


def first_k(df: DataFrame, query: str, k: int) -> DataFrame:
    """As they are fused."""
    return df.orderBy(F.desc("score"), "chunk_id" if "chunk_id" in df.columns else "doc_id").limit(k)


def model_documents(df: DataFrame, query: str, k: int, scorer: Scorer, *, recency: bool = False, quality: Column | None = None, weights: tuple[float, float, float] = DOCUMENT_WEIGHTS) -> DataFrame:
    ruled = rule_documents(df, query, fusion.CANDIDATES, recency=recency, quality=quality)
    order = [F.desc("score"), F.desc(F.coalesce(year("publication_date"), F.lit(0))), F.col("doc_id")]
    return blend(model_scores(ruled, query, document_text(ruled.columns), scorer), weights, order, k, quality)


def model_chunks(df: DataFrame, query: str, k: int, scorer: Scorer, *, weights: tuple[float, float, float] = CHUNK_WEIGHTS) -> DataFrame:
    ruled = rule_chunks(df, query, fusion.CANDIDATES)
    order = [F.desc("score"), F.desc(F.coalesce("token_count", F.lit(0))), F.col("chunk_id")]
    return blend(model_scores(ruled, query, chunk_text(), scorer), weights, order, k)


def reranker(of: str, mode: str | None = None, scorer: Scorer | None = None, **how) -> Reranker:
    """By mode, or by TESSELLA_DOCUMENT_RERANKER, TESSELLA_CHUNK_RERANKER: none, rule, or model, which needs a scorer; the default is model with
    a scorer and rule without one. of: documents or chunks."""
    mode = (mode or os.environ.get(f"TESSELLA_{of.upper().rstrip('S')}_RERANKER") or ("model" if scorer else "rule")).strip().lower()
    if mode in ("none", "noop", "off"):
        return first_k
    if mode in ("rule", "rules", "rule_based"):
        return (lambda df, q, k: rule_documents(df, q, k, **how)) if of == "documents" else (lambda df, q, k: rule_chunks(df, q, k))
    if scorer is None:
        raise ValueError(f"re-ranking by {mode} needs a scorer")
    return (lambda df, q, k: model_documents(df, q, k, scorer, **how)) if of == "documents" else (lambda df, q, k: model_chunks(df, q, k, scorer, **how))
