"""The queries on training text by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import encode, encoding, leaks, markup, rank, residue, scan, split, visual

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": split.p1_found,
    "p1_pieces": split.p1_pieces,
    "p5_found": rank.p5_found,
    "p5_ranked": rank.p5_ranked,
    "p2_found": residue.p2_found,
    "p2_kept": residue.p2_kept,
    "p3_found": scan.p3_found,
    "p3_repaired": scan.p3_repaired,
    "p4_found": encoding.p4_found,
    "p4_restored": encoding.p4_restored,
    "p6_found": markup.p6_found,
    "p6_cleaned": markup.p6_cleaned,
    "p7_ids": encode.p7_ids,
    "p8_found": leaks.p8_found,
    "p9_found": visual.p9_found,
}
SQL: dict[str, str] = {
    "p1_found": split.P1_FOUND_SQL,
    "p5_found": rank.P5_FOUND_SQL,
    "p5_ranked": rank.P5_RANKED_SQL,
}
