"""Joins of derived tables with their documents, context of chunks, and what is missing or out of step.

No side is hinted for broadcast: the optimizer broadcasts a side under its size threshold, which it checks at run time,
and hashes both sides otherwise; hot keys are split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_document(df: DataFrame, documents: DataFrame, columns: Sequence[str], on: str = "doc_id") -> DataFrame:
    return df.join(documents.select(on, *columns), on)


def missing_vectors(source: DataFrame, vectors: DataFrame, id_col: str, model: str) -> DataFrame:
    """Rows without a vector of this model."""
    return source.join(vectors.filter(F.col("model") == model).select(id_col), id_col, "left_anti")


def new_documents(incoming: DataFrame, existing: DataFrame, on: str = "doc_id") -> DataFrame:
    return incoming.join(existing.select(on), on, "left_anti")


def known_sections(sections: DataFrame, documents: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Sections whose document is known, without those that are there already."""
    out = sections.join(documents.select("doc_id"), "doc_id", "left_semi")
    return out.join(existing.select("doc_id", "section_index"), ["doc_id", "section_index"], "left_anti") if existing is not None else out


def section_context(items: DataFrame, sections: DataFrame, doc: str = "doc_id", path: str = "section_path") -> DataFrame:
    """Items with heading and offsets of the first section of their document and path; without one the heading is the path's last
    part. The sections are reduced to one for each key before the join."""
    first = sections.groupBy(doc, F.to_json(path).alias("__path")).agg(F.min_by(F.struct("heading", "char_start", "char_end"), "section_index").alias("__s"))
    x = items.withColumn("__path", F.to_json(path)).join(first, [doc, "__path"], "left")
    both = F.col("__s.char_start").isNotNull() & F.col("__s.char_end").isNotNull()
    return x.withColumns({
        "heading": F.coalesce(F.col("__s.heading"), F.try_element_at(path, F.lit(-1))),
        "char_start": F.col("__s.char_start"), "char_end": F.col("__s.char_end"), "char_span_kind": F.when(both, "section"),
    }).drop("__path", "__s")


def inherit(chunks: DataFrame, documents: DataFrame, columns: dict[str, object], on: str = "doc_id") -> DataFrame:
    """A chunk's own value, else its document's, else the default."""
    d = documents.select(on, *[F.col(c).alias(f"__{c}") for c in columns])
    x = chunks.join(d, on, "left")
    own = {c: F.nullif(F.col(c), F.lit("")) if c in chunks.columns else F.lit(None).cast("string") for c in columns}
    return x.withColumns({c: F.coalesce(own[c], F.nullif(F.col(f"__{c}"), F.lit("")), F.lit(v)) for c, v in columns.items()}).drop(*[f"__{c}" for c in columns])


def blocks_to_sections(sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each block with its section: the lists of children opened to rows, an equi-join on the block."""
    return sections.select("section_id", F.explode("child_block_ids").alias("block_id")).join(blocks, "block_id")


def sync_metadata(derived: DataFrame, documents: DataFrame, columns: Sequence[str], on: str = "doc_id") -> DataFrame:
    """Rows of known documents with the documents' values, and whether anything changed; orphans are dropped."""
    d = documents.select(on, *[F.col(c).alias(f"__{c}") for c in columns])
    x = derived.join(d, on)
    changed: Column = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(c).eqNullSafe(F.coalesce(f"__{c}", c))
    return x.withColumn("changed", changed).withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop(*[f"__{c}" for c in columns])


def check_subset(df: DataFrame, labels: str, parent: str) -> DataFrame:
    """An error where a part has labels that its document lacks."""
    extra = F.array_except(labels, parent)
    return df.withColumn(labels, F.when(F.size(extra) > 0, F.raise_error(F.concat(F.lit("labels not of the document: "), F.array_join(extra, ","))).cast("array<string>")).otherwise(F.col(labels)))
