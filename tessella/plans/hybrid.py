"""Search, read and retrieve: channels, fusion, routing, re-ranking, fallback and context as one lazy plan each.

A channel turns each row into an id and a score in the scan; rows delivered again are reduced to the last, the kind is asked of the
documents and the first k taken among those narrow rows. Texts and fields are read again for the few candidates alone.

The re-ranker of documents gets titles, dates and scores, and no text of cards, views or chunks, and an agreement of as many
channels as the request has: so do the requests of a service over stored tables, which this is for. With texts,
`rerank.rule_documents` can be called on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.records import department_fields, hash_vector, hashing_similarity
from tessella.functions.text import retrieval_text
from tessella.operators import fusion, rerank, search
from tessella.operators.filters import search_filter, without_references
from tessella.operators.joins import section_context

AT = "ingested_at"


@dataclass
class Request:
    query: str
    institution: str | None = None
    department: str | None = None
    time_range: str | dict | None = None
    date: str | None = None
    kind: str | None = None
    topk: int = 10
    recency: bool = False

    def filtered(self, df: DataFrame) -> DataFrame:
        """By all but the kind, which is the document's."""
        return search_filter(df, institution=self.institution, department=self.department, date=self.date, time_range=self.time_range)


@dataclass
class Vectors:
    """Stored vectors (id, model, embedding) of a table's rows, and the query's encoder."""

    table: DataFrame
    model: str
    encode: Callable[[str], list[float]] = hash_vector

    def scores(self, rows: DataFrame, id_col: str, query: str) -> DataFrame:
        """The rows that have a vector of the model, with its cosine to the query. Only ids and scores are joined."""
        q = self.encode(query)
        s = self.table.filter((F.col("model") == self.model) & (F.size("embedding") == len(q))).select(F.col("id").alias(id_col), search.cosine_to("embedding", q).alias("score"))
        return rows.join(s, id_col)


def of_kind(rows: DataFrame, documents: DataFrame, kind: str | None) -> DataFrame:
    """Of documents that are stored, and of the kind if one is asked for."""
    d = documents.filter(F.col("document_kind") == kind) if kind else documents
    return rows.join(d.select("doc_id"), "doc_id", "left_semi")


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def lexical(request: Request, df: DataFrame, fields: list[tuple[Column | str, str]], id_col: str, keep: list[str]) -> DataFrame:
    return search.full_text(request.filtered(df), request.query, fields, id_col, keep, AT)


def dense(request: Request, df: DataFrame, text: str, id_col: str, keep: list[str], vectors: Vectors | None) -> DataFrame:
    """By stored vectors; without them by the offline encoder, in the scan."""
    rows = request.filtered(df)
    if vectors:
        return vectors.scores(search.delivered_last(rows.select(id_col, *keep, AT), id_col, AT), id_col, request.query)
    return search.delivered_last(rows.select(id_col, *keep, F.round(hashing_similarity(text, request.query), 6).alias("score"), AT), id_col, AT)


def search_documents(request: Request, documents: DataFrame, cards: DataFrame, views: DataFrame, *, with_dense: bool = True, vectors: dict[str, Vectors] | None = None, reranker: rerank.Reranker | None = None) -> DataFrame:
    """Up to 20 documents. documents: doc_id, title, clinical_department, publication_date, document_kind, once each."""
    recall, candidates = fusion.sizes(request.topk)
    held = vectors or {}
    lists = [
        ("card_text", lexical(request, cards, [("title", "A"), ("clinical_department", "B"), ("card_text", "C")], "doc_id", []), "doc_id"),
        ("view_text", lexical(request, views, [("title", "A"), ("view_type", "B"), ("clinical_department", "B"), ("text", "C")], "view_id", ["doc_id"]), "view_id"),
    ]
    if with_dense:
        lists += [
            ("card_dense", dense(request, cards, "card_text", "doc_id", [], held.get("cards")), "doc_id"),
            ("view_dense", dense(request, views, "text", "view_id", ["doc_id"], held.get("views")), "view_id"),
        ]
    ranks = None
    for name, rows, id_col in lists:
        rows = of_kind(rows, documents, request.kind)
        if id_col == "doc_id":
            top = rows.orderBy(F.desc("score"), "doc_id").limit(recall)
        else:
            top = fusion.unique_documents(rows.select("doc_id", "score", F.col(id_col).alias("id")), recall)
        one = fusion.ranked(top, "doc_id", name)
        ranks = one if ranks is None else ranks.unionByName(one)
    fused = fusion.rrf(ranks).withColumnRenamed("id", "doc_id")
    x = documents.join(F.broadcast(fused), "doc_id")  # at most as many rows as the channels' top-k together
    x = x.withColumns({"scope": department_fields("clinical_department")["scope"], "channels": F.lit(len(lists))})
    order = [F.desc("score"), F.col("doc_id")]
    x = fusion.quota(x, "scope", order, {"single": 45, "compositive": 5}, fusion.CANDIDATES) if request.department else x.orderBy(*order).limit(fusion.CANDIDATES)
    x = x.orderBy(*order).limit(candidates).withColumns({c: F.lit("") for c in ("card_text", "view_text", "chunk_text")})
    by = reranker or rerank.reranker("documents", "rule", recency=request.recency)
    return by(x, request.query, min(request.topk, fusion.DOCUMENT_CAP))


CHUNK_FIELDS = ["doc_id", "title", "section_path", "chunk_index", "content", "chunk_type", "is_reference_section", "token_count", "publication_date", "source_institution", "clinical_department"]


def retrieve_chunks(request: Request, documents: DataFrame, chunks: DataFrame, sections: DataFrame, *, with_dense: bool = True, vectors: Vectors | None = None, reranker: rerank.Reranker | None = None) -> DataFrame:
    """Up to 30 chunks with heading and offsets of their section."""
    recall, candidates = fusion.sizes(request.topk)
    base = without_references(chunks)
    path = F.coalesce("section_path", F.array().cast("array<string>"))
    text = retrieval_text(_text("title"), path, _text("chunk_type"), _text("content"))
    fields = [("title", "A"), (F.array_join(path, " "), "B"), ("clinical_department", "B"), ("chunk_type", "B"), (text, "C")]
    lists = [("chunk_text", lexical(request, base, fields, "chunk_id", ["doc_id"]))]
    if with_dense:
        lists.append(("chunk_dense", dense(request, base, "content", "chunk_id", ["doc_id"], vectors)))
    ranks = None
    for name, rows in lists:
        top = of_kind(rows, documents, request.kind).orderBy(F.desc("score"), "chunk_id").limit(recall)
        one = fusion.ranked(top, "chunk_id", name)
        ranks = one if ranks is None else ranks.unionByName(one)
    x = search.payload(fusion.rrf(ranks).withColumnRenamed("id", "chunk_id"), chunks, "chunk_id", CHUNK_FIELDS, AT)
    order = [F.desc("score"), F.col("chunk_id")]
    if request.department:  # the scope is the document's, as chunks have one department
        scopes = documents.join(F.broadcast(x.select("doc_id").distinct()), "doc_id", "left_semi").select("doc_id", department_fields("clinical_department")["scope"].alias("scope"))
        x = x.join(scopes, "doc_id", "left").withColumn("scope", F.coalesce("scope", F.lit("single")))
        x = fusion.quota(x, "scope", order, {"single": 91, "compositive": 9}, 100)
    by = reranker or rerank.reranker("chunks", "rule")
    out = by(x.orderBy(*order).limit(candidates), request.query, min(request.topk, fusion.CHUNK_CAP))
    near = sections.select("doc_id", "section_path", "section_index", "heading", "char_start", "char_end").join(F.broadcast(out.select("doc_id").distinct()), "doc_id", "left_semi")
    return section_context(out, near)


def with_fallback(request: Request, run, id_col: str, first: str = "guideline", second: str = "consensus") -> DataFrame:
    """The request on the first kind, filled up from the second."""
    a, b = run(replace(request, kind=first)), run(replace(request, kind=second))
    return fusion.fallback(a, b, [F.desc("score"), F.col(id_col)], request.topk, id_col)
