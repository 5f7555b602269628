"""search, read and retrieve over a folder of tables. What the tools of a service would call; the answers are DataFrames."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import fusion
from tessella.operators.filters import read_document
from tessella.operators.search import delivered_last
from tessella.plans.hybrid import Request, Vectors, retrieve_chunks, search_documents, with_fallback
from tessella.sources.tables import spread, table


class Store:
    """Tables of a folder; rows delivered again count once, as the last. vectors: stored vectors of cards, views and chunks by name."""

    def __init__(self, spark: SparkSession, folder: str, vectors: dict[str, Vectors] | None = None):
        self.documents = table(spark, folder, "documents")
        fields = self.documents.select(F.col("doc_key").alias("doc_id"), "title", "publication_date", "source_institution", "clinical_department", "document_kind", "updated_at")
        self.by_key = delivered_last(fields, "doc_id", "updated_at")
        self.cards, self.views, self.chunks = (spread(table(spark, folder, t)) for t in ("document_cards", "document_views", "chunks"))
        self.sections = table(spark, folder, "sections")
        self.vectors = vectors or {}

    def search(self, query: str, **how) -> DataFrame:
        """Documents; of any kind unless `kind` is given."""
        return search_documents(Request(query, **how), self.by_key, self.cards, self.views, vectors=self.vectors)

    def search_with_fallback(self, query: str, **how) -> DataFrame:
        """Guidelines, filled up with consensus documents."""
        r = Request(query, **how)
        return with_fallback(replace(r, topk=min(r.topk, fusion.DOCUMENT_CAP)), lambda r: search_documents(r, self.by_key, self.cards, self.views, vectors=self.vectors), "doc_id")

    def read(self, doc_id: str | None = None, title: str | None = None, max_chars: int = 0) -> DataFrame:
        return read_document(self.documents, doc_id=doc_id, title=title, max_chars=max_chars)

    def retrieve(self, query: str, **how) -> DataFrame:
        return retrieve_chunks(Request(query, **{"topk": 5, **how}), self.by_key, self.chunks, self.sections, vectors=self.vectors.get("chunks"))

    def retrieve_with_fallback(self, query: str, **how) -> DataFrame:
        r = Request(query, **{"topk": 5, **how})
        return with_fallback(replace(r, topk=min(r.topk, fusion.CHUNK_CAP)), lambda r: retrieve_chunks(r, self.by_key, self.chunks, self.sections, vectors=self.vectors.get("chunks")), "chunk_id")
