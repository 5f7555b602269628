"""Queries by name over a folder of tables, and SQL that gives the same rows.

Each query runs over its whole tables. A LIMIT stands only where a top-k or a cap is the operator itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import records as R
from tessella.functions import text as X
from tessella.operators import aggregates, chunking, classify, cleaning, filters, fusion, joins, markdown, metadata, rerank, search, structural, views
from tessella.plans import hybrid
from tessella.session import cut
from tessella.sources import files, ingest, models
from tessella.sources.tables import spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

QUERY = "telephone follow-up for chronic heart failure"
TERMS = ["telephone", "follow-up", "chronic", "heart", "failure"]
DEPARTMENTS = (
    ("respiratory", "asthma", 4, 1), ("respiratory", "pneumonia", 4, 1), ("respiratory", "哮喘", 4, 1), ("cardiology", "heart failure", 4, 1), ("cardiology", "hypertension", 4, 1),
    ("cardiology", "高血压", 4, 1), ("nephrology", "kidney disease", 4, 1), ("nephrology", "renal", 2, 1), ("endocrinology", "diabetes", 4, 1), ("endocrinology", "痛风", 4, 1),
)
HINTS = {"pdf": "scanned files", "markdown_clean": "cleaned files"}
BOOSTS = {"recommendation": 1.3, "evidence": 1.2, "table": 1.1, "background": 0.6, "reference": 0.1}
#: A query vector by rule, as long as the embeddings.
VECTOR = [((i * 37) % 64) / 64.0 - 0.5 for i in range(64)]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _docs(s: SparkSession, d: str) -> DataFrame:
    """Documents, of a key delivered again the last."""
    c = ["title", "abstract", "publication_date", "source_institution", "clinical_department", "document_kind"]
    x = table(s, d, "documents").groupBy(F.col("doc_key").alias("doc_id")).agg(F.max_by(F.struct(*c), F.struct("updated_at", F.col("doc_id").alias("i"))).alias("r"))
    return x.select("doc_id", "r.*")


DOCS_SQL = """docs AS (SELECT doc_key AS doc_id, r.title AS title, r.abstract AS abstract, r.publication_date AS publication_date, r.source_institution AS source_institution, r.clinical_department AS clinical_department, r.document_kind AS document_kind
  FROM (SELECT doc_key, arg_max({'title': title, 'abstract': abstract, 'publication_date': publication_date, 'source_institution': source_institution, 'clinical_department': clinical_department, 'document_kind': document_kind}, (updated_at, doc_id)) AS r FROM documents GROUP BY doc_key))"""


def _chunks(s: SparkSession, d: str, *columns: str) -> DataFrame:
    """Chunks with the named columns, once each: rows delivered again differ only in when."""
    need = list(dict.fromkeys(["chunk_id", "ingested_at", *columns])) if columns else []
    return ingest.latest(spread(table(s, d, "chunks", *need)), ["chunk_id"], "ingested_at")


def _raw(s: SparkSession, d: str, *columns: str) -> DataFrame:
    """Chunks as delivered, for operators that reduce ids themselves after texts have become numbers."""
    return spread(table(s, d, "chunks", *dict.fromkeys(["chunk_id", "ingested_at", *columns])))


_SP = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BL = r"[ \t\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SP}+|{_SP}+$', '', 'g')"


CHUNKS_SQL = "ch AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id, ingested_at DESC)"

# -- filters and lookups


@query("filter_ilike_kind", "SELECT doc_id, doc_key, source_institution, document_kind FROM documents WHERE source_institution ILIKE '%council%' AND document_kind = 'guideline'")
def _(s, d):
    return filters.search_filter(table(s, d, "documents", "doc_id", "doc_key", "source_institution", "document_kind"), institution="council", kind="guideline")


@query("time_range_text", "SELECT doc_id, publication_date FROM documents WHERE publication_date >= '2016-01-01' AND publication_date <= '2021-12-31'")
def _(s, d):
    return filters.search_filter(table(s, d, "documents", "doc_id", "publication_date"), time_range="2016-05-01~2021-06-30")


@query("time_lower_bound", "SELECT doc_id, publication_date FROM documents WHERE publication_date >= '2022'")
def _(s, d):
    return filters.search_filter(table(s, d, "documents", "doc_id", "publication_date"), time_range="2022")


@query("read_lookup", f"""WITH t AS (SELECT arg_min(title, (length(title), title)) AS title FROM documents WHERE title != ''), x AS (SELECT d.*, CASE WHEN lower(d.title) = lower(t.title) THEN 0 ELSE 1 END AS exact FROM documents d, t WHERE contains(lower(d.title), lower(t.title)))
SELECT doc_id, title, substr(content_md, 1, 200) AS content_md FROM x ORDER BY exact, publication_date DESC NULLS LAST, length(title), doc_id LIMIT 1""")
def _(s, d):
    """By a title that is there: the shortest one."""
    docs = table(s, d, "documents")
    title = docs.filter("title != ''").agg(F.min_by("title", F.struct(F.length("title"), "title"))).first()[0]
    return filters.read_document(docs, title=title, max_chars=200).select("doc_id", "title", "content_md")


@query("json_metadata_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase') AND TRY_CAST(json_extract_string(props, '$.k') AS INT) = 7")
def _(s, d):
    e = table(s, d, "events", "event_id", "event_type", "props").withColumn("metadata", F.from_json("props", "map<string,string>"))
    return filters.metadata_filter(e, {"event_type": ["click", "purchase"], "k": "7", "missing": None}).select("event_id", "event_type")


# -- joins


@query("join_chunk_document", f"WITH {DOCS_SQL}, {CHUNKS_SQL} SELECT docs.document_kind, ch.chunk_type, count(*) AS n, sum(ch.chunk_index) AS s FROM ch JOIN docs USING (doc_id) GROUP BY ALL")
def _(s, d):
    x = joins.with_document(_chunks(s, d, "chunk_id", "doc_id", "chunk_type", "chunk_index").select("chunk_id", "doc_id", "chunk_type", "chunk_index"), _docs(s, d), ["document_kind"])
    return x.groupBy("document_kind", "chunk_type").agg(F.count("*").alias("n"), F.sum("chunk_index").alias("s"))


@query("anti_missing_vectors", "SELECT DISTINCT doc_key AS id FROM documents WHERE doc_key NOT IN (SELECT doc_id FROM document_cards)")
def _(s, d):
    have = table(s, d, "document_cards", "doc_id").select(F.col("doc_id").alias("id"), F.lit("m").alias("model"))
    return joins.missing_vectors(table(s, d, "documents").select(F.col("doc_key").alias("id")).distinct(), have, "id", "m")


@query("semi_known_sections", "SELECT doc_id, count(*) AS n FROM sections WHERE doc_id IN (SELECT doc_id FROM document_cards) GROUP BY doc_id")
def _(s, d):
    return joins.known_sections(table(s, d, "sections", "doc_id", "section_index"), table(s, d, "document_cards", "doc_id")).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("context_enrich", f"""WITH {CHUNKS_SQL}, sec AS (SELECT doc_id, section_path, arg_min({{'h': heading, 'a': char_start, 'b': char_end}}, section_index) AS x FROM sections GROUP BY ALL)
SELECT ch.chunk_id, coalesce(x.h, ch.section_path[-1]) AS heading, x.a AS char_start, x.b AS char_end, CASE WHEN x.a IS NOT NULL AND x.b IS NOT NULL THEN 'section' END AS char_span_kind
FROM ch LEFT JOIN sec ON ch.doc_id = sec.doc_id AND ch.section_path = sec.section_path""")
def _(s, d):
    x = joins.section_context(_chunks(s, d, "chunk_id", "doc_id", "section_path").select("chunk_id", "doc_id", "section_path"), table(s, d, "sections"))
    return x.select("chunk_id", "heading", "char_start", "char_end", "char_span_kind")


@query("distinct_on_first", "SELECT doc_id, array_to_string(section_path, ' > ') AS path, min(section_index) AS section_index FROM sections GROUP BY ALL")
def _(s, d):
    x = table(s, d, "sections").select("doc_id", F.array_join("section_path", " > ").alias("path"), "section_index")
    return fusion.first_per(x, ["doc_id", "path"], [F.col("section_index")])


@query("inherit_metadata", f"""WITH {DOCS_SQL}, {CHUNKS_SQL} SELECT ch.chunk_id, coalesce(nullif(ch.document_kind, ''), nullif(docs.document_kind, ''), 'guideline') AS document_kind, coalesce(nullif(ch.publication_date, ''), nullif(docs.publication_date, ''), 'unknown') AS publication_date
FROM ch LEFT JOIN docs USING (doc_id)""")
def _(s, d):
    x = joins.inherit(_chunks(s, d, "chunk_id", "doc_id", "document_kind", "publication_date").select("chunk_id", "doc_id", "document_kind", "publication_date"), _docs(s, d), {"document_kind": "guideline", "publication_date": "unknown"})
    return x.select("chunk_id", "document_kind", "publication_date")


@query("sync_metadata", f"""WITH {DOCS_SQL}, {CHUNKS_SQL} SELECT docs.source_institution AS source_institution, count(*) AS n, count(*) FILTER (WHERE ch.title IS DISTINCT FROM coalesce(docs.title, ch.title) OR ch.clinical_department IS DISTINCT FROM coalesce(docs.clinical_department, ch.clinical_department)) AS n_changed
FROM ch JOIN docs USING (doc_id) GROUP BY ALL""")
def _(s, d):
    docs = _docs(s, d)
    x = joins.sync_metadata(_chunks(s, d, "chunk_id", "doc_id", "title", "clinical_department").select("chunk_id", "doc_id", "title", "clinical_department"), docs, ["title", "clinical_department"])
    return x.join(docs.select("doc_id", "source_institution"), "doc_id").groupBy("source_institution").agg(F.count("*").alias("n"), F.count_if("changed").alias("n_changed"))


# -- aggregates


@query("kind_counts", "SELECT document_kind, count(*) AS n FROM documents GROUP BY ALL")
def _(s, d):
    return aggregates.kind_counts(table(s, d, "documents", "document_kind"))


@query("source_distribution", "SELECT source_institution, count(*) AS n FROM documents GROUP BY ALL")
def _(s, d):
    return aggregates.distribution(table(s, d, "documents", "source_institution"), "source_institution")


STATS_TABLES = ("documents", "sections", "chunks", "document_cards", "document_views", "rank_candidates", "eval_items", "embeddings")
_DATED = ("documents", "sections", "chunks", "document_cards", "document_views")


@query("table_stats", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n, {'count(*) FILTER (WHERE publication_date = ' + chr(39) + 'unknown' + chr(39) + ')' if t in _DATED else 'NULL::BIGINT'} AS unknown_dates FROM {t}" for t in STATS_TABLES))
def _(s, d):
    return aggregates.table_stats({t: table(s, d, t) for t in STATS_TABLES})


def _check_sql(name: str, source: str) -> str:
    return f"SELECT k.kind, '{name}' AS check_name, coalesce(x.n, 0) > 0 AS ok FROM k LEFT JOIN (SELECT docs.document_kind AS kind, count(*) AS n FROM {source} JOIN docs USING (doc_id) GROUP BY ALL) x USING (kind)"


@query("snapshot_checks", f"""WITH {DOCS_SQL}, k(kind) AS (VALUES ('guideline'), ('consensus')), n AS (SELECT document_kind AS kind, count(DISTINCT doc_id) AS documents FROM docs GROUP BY ALL),
c AS (SELECT docs.document_kind AS kind, count(DISTINCT doc_id) AS n FROM document_cards JOIN docs USING (doc_id) GROUP BY ALL)
SELECT k.kind, 'documents' AS check_name, coalesce(n.documents, 0) > 0 AS ok FROM k LEFT JOIN n USING (kind) UNION ALL SELECT k.kind, 'cards', coalesce(c.n, 0) = coalesce(n.documents, 0) FROM k LEFT JOIN n USING (kind) LEFT JOIN c USING (kind)
UNION ALL {_check_sql("chunks", "chunks")} UNION ALL {_check_sql("views", "document_views")} UNION ALL {_check_sql("sections", "sections")} UNION ALL {_check_sql("vectors", "(SELECT DISTINCT doc_id FROM document_cards WHERE card_text != '')")}""")
def _(s, d):
    vectors = table(s, d, "document_cards", "doc_id", "card_text").filter("card_text != ''")  # what vectors are made of
    return aggregates.snapshot_problems(_docs(s, d), {"cards": table(s, d, "document_cards"), "chunks": table(s, d, "chunks"), "views": table(s, d, "document_views"), "sections": table(s, d, "sections"), "vectors": vectors})


@query("content_hash_dedup", """WITH x AS (SELECT doc_id, sha256(coalesce(content_md, '')) AS digest, CASE WHEN document_kind = 'consensus' THEN 1 ELSE 0 END AS k FROM documents),
f AS (SELECT digest, arg_min(doc_id, (k, doc_id)) AS canonical, count(*) AS n FROM x GROUP BY digest) SELECT x.digest, f.canonical, x.doc_id FROM x JOIN f USING (digest) WHERE n > 1 AND x.doc_id != f.canonical""")
def _(s, d):
    x = table(s, d, "documents", "doc_id", "content_md", "document_kind")
    return aggregates.duplicates_by_content(x, "doc_id", "content_md", [F.when(F.col("document_kind") == "consensus", 1).otherwise(0)])


@query("latest_by_key", "SELECT doc_key, max(updated_at) AS updated_at, arg_max(doc_id, updated_at) AS doc_id FROM documents GROUP BY doc_key")
def _(s, d):
    return ingest.latest(table(s, d, "documents", "doc_key", "doc_id", "updated_at").withColumn("at", F.col("updated_at")), ["doc_key"], "at").select("doc_key", "doc_id", "updated_at")


@query("duplicate_keys", "SELECT doc_key, count(*) AS n FROM documents GROUP BY doc_key HAVING count(*) > 1")
def _(s, d):
    return aggregates.duplicate_keys(table(s, d, "documents", "doc_key"), "doc_key")


@query("repair_documents", r"""SELECT doc_id, trim(regexp_replace(coalesce(title, ''), '[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}]+', ' ', 'g')) AS new_title, CAST(nullif(regexp_extract(publication_date, '(19\d{2}|20\d{2})', 1), '') AS INT) AS new_year, sha256(coalesce(content_md, '')) AS content_sha256, trim(regexp_replace(coalesce(title, ''), '[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}]+', ' ', 'g')) IS DISTINCT FROM title OR CAST(nullif(regexp_extract(publication_date, '(19\d{2}|20\d{2})', 1), '') AS INT) IS DISTINCT FROM publication_year AS repaired
FROM documents WHERE CAST(nullif(regexp_extract(publication_date, '(19\d{2}|20\d{2})', 1), '') AS INT) BETWEEN 2012 AND 2026""")
def _(s, d):
    return aggregates.repair_documents(table(s, d, "documents"), 2012, 2026).select("doc_id", "new_title", "new_year", "content_sha256", "repaired")


_AT_K = (5, 10, 20, 50)


@query("recall_mrr", f"""WITH r AS (SELECT DISTINCT query_id, chunk_id AS id, split_part(chunk_id, '#', 1) AS doc_id, bm25_score, dense_distance FROM rank_candidates), t AS (SELECT chunk_id AS id, max(chunk_type) AS chunk_type FROM chunks GROUP BY ALL),
a AS (SELECT query_id, id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC NULLS LAST, id) AS rank FROM (SELECT query_id, id, doc_id, max(bm25_score) AS s FROM r GROUP BY ALL)),
rel AS (SELECT DISTINCT query_id, id FROM r WHERE dense_distance < 0.3), rd AS (SELECT DISTINCT query_id, doc_id, 1 AS d FROM r WHERE dense_distance < 0.3), n AS (SELECT query_id, count(*) AS n FROM rel GROUP BY ALL),
p AS (SELECT q.query_id, max(coalesce(n.n, 0)) AS n, {", ".join(f"count(rel.id) FILTER (WHERE rank <= {k}) AS h{k}" for k in _AT_K)}, min(rank) FILTER (WHERE rank <= 10 AND rel.id IS NOT NULL) AS f, coalesce(max(rd.d) FILTER (WHERE rank <= 10), 0) AS d,
  count(a.id) FILTER (WHERE rank <= 10) AS n10, count(a.id) FILTER (WHERE rank <= 10 AND t.chunk_type IN ({", ".join(repr(x) for x in aggregates.HIGH_VALUE)})) AS ty
  FROM (SELECT DISTINCT query_id FROM r) q LEFT JOIN a USING (query_id) LEFT JOIN rel ON rel.query_id = a.query_id AND rel.id = a.id LEFT JOIN rd ON rd.query_id = a.query_id AND rd.doc_id = a.doc_id LEFT JOIN n ON n.query_id = q.query_id LEFT JOIN t ON t.id = a.id GROUP BY ALL)
SELECT {", ".join(f"round(avg(CASE WHEN n > 0 THEN h{k} / n ELSE 0 END), 6) AS recall_{k}" for k in _AT_K)}, round(avg(coalesce(1.0::DOUBLE / f, 0)), 6) AS mrr_10, round(avg(d::DOUBLE), 6) AS doc_recall_10, round(avg(CASE WHEN n10 > 0 THEN ty / n10 ELSE 0 END), 6) AS type_precision_10 FROM p""")
def _(s, d):
    r = table(s, d, "rank_candidates").select("query_id", F.col("chunk_id").alias("id"), F.substring_index("chunk_id", "#", 1).alias("doc_id"), "bm25_score", "dense_distance")
    types = table(s, d, "chunks", "chunk_id", "chunk_type").groupBy(F.col("chunk_id").alias("id")).agg(F.max("chunk_type").alias("chunk_type"))
    best = r.groupBy("query_id", "id", "doc_id").agg(F.max("bm25_score").alias("score"))
    hits = fusion.rank_within(best, ["query_id"], "id", F.col("score")).join(types, "id", "left")
    return aggregates.retrieval_metrics(hits, r.filter("dense_distance < 0.3"), r.select("query_id").distinct())


# -- scalar functions


@query("tokenize_counts", r"SELECT chunk_id, max(len(regexp_extract_all(coalesce(content, ''), '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[\x{4e00}-\x{9fff}]'))) AS n FROM chunks GROUP BY chunk_id")
def _(s, d):
    return table(s, d, "chunks", "chunk_id", "content").groupBy("chunk_id").agg(F.max(X.token_count("content")).alias("n"))


@query("record_fields", r"""SELECT doc_id, CAST(nullif(regexp_extract(coalesce(publication_date, ''), '(19\d{2}|20\d{2})', 1), '') AS INT) AS y, coalesce(regexp_matches(publication_date, '^20[12]\d-\d{2}-\d{2}$'), false) AS valid,
coalesce(greatest(0.0::DOUBLE, least(0.12::DOUBLE, (CAST(nullif(regexp_extract(publication_date, '(19\d{2}|20\d{2})', 1), '') AS INT) - 2012) / 14.0::DOUBLE * 0.12::DOUBLE)), 0.0) AS boost,
CASE WHEN len(list_distinct(list_filter(string_split(coalesce(clinical_department, ''), '|'), lambda x: trim(x) != ''))) > 1 THEN 'compositive' ELSE 'single' END AS scope FROM documents""")
def _(s, d):
    x = table(s, d, "documents", "doc_id", "publication_date", "clinical_department")
    return x.select("doc_id", R.year("publication_date").alias("y"), R.valid_date("publication_date").alias("valid"), R.recency_boost("publication_date").alias("boost"), R.department_fields("clinical_department")["scope"].alias("scope"))


@query("truthy_coerce", "SELECT lower(trim(ocr_applied)) AS v, count(*) AS n, count(*) FILTER (WHERE lower(trim(ocr_applied)) IN ('1', 'true', 'yes', 'y')) AS n_true FROM document_cards GROUP BY ALL")
def _(s, d):
    return table(s, d, "document_cards", "ocr_applied").groupBy(F.lower(F.trim("ocr_applied")).alias("v")).agg(F.count("*").alias("n"), F.count_if(R.truthy("ocr_applied")).alias("n_true"))


@query("cleaning_flag_counts", r"SELECT f AS flag, count(*) AS n FROM (SELECT unnest(list_filter(list_transform(regexp_split_to_array(coalesce(cleaning_flags, ''), '[,;]\s*'), lambda x: trim(x)), lambda x: x != '')) AS f FROM document_cards) GROUP BY ALL")
def _(s, d):
    return table(s, d, "document_cards", "cleaning_flags").select(F.explode(X.flags("cleaning_flags")).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query("term_overlap", "SELECT doc_id, ((CASE WHEN contains(lower(t), 'telephone') THEN 1 ELSE 0 END) + (CASE WHEN contains(lower(t), 'follow-up') THEN 1 ELSE 0 END) + (CASE WHEN contains(lower(t), 'chronic') THEN 1 ELSE 0 END) + (CASE WHEN contains(lower(t), 'heart') THEN 1 ELSE 0 END) + (CASE WHEN contains(lower(t), 'failure') THEN 1 ELSE 0 END)) / 5.0::DOUBLE AS overlap FROM (SELECT doc_id, coalesce(title, '') AS t FROM documents)")
def _(s, d):
    return table(s, d, "documents", "doc_id", "title").select("doc_id", X.term_overlap("title", TERMS).alias("overlap"))


@query("query_terms", r"SELECT item_id, array_to_string(list_distinct_ordered, ' ') AS terms FROM (SELECT item_id, list_transform(list_filter(list_zip(t, range(1, len(t) + 1)), lambda p: list_position(t, p[1]) = p[2]), lambda p: p[1]) AS list_distinct_ordered FROM (SELECT item_id, regexp_extract_all(lower(text), '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[\x{4e00}-\x{9fff}]+') AS t FROM eval_items))")
def _(s, d):
    return table(s, d, "eval_items").select("item_id", F.array_join(X.terms("text"), " ").alias("terms"))


@query("clip_text", r"""SELECT doc_id, CASE WHEN length(t) <= 80 THEN t ELSE rtrim(substr(t, 1, 80)) || '...' END AS clipped FROM (SELECT doc_id, trim(regexp_replace(coalesce(abstract, ''), '[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}]+', ' ', 'g')) AS t FROM documents)""")
def _(s, d):
    return table(s, d, "documents", "doc_id", "abstract").select("doc_id", X.clip("abstract", 80).alias("clipped"))


_CLASS = {"signal": r"\p{L}\p{N}\x{4e00}-\x{9fff}\x{3040}-\x{30ff}", "cjk": r"\x{4e00}-\x{9fff}\x{3040}-\x{30ff}", "weird": r"\x7f-\x{9f}\x{ac}\x{ae}\x{af}\x{b1}\x{b4}-\x{b6}\x{b8}-\x{be}\x{370}-\x{3ff}", "marks": X.MARKERS}


def _signal_sql(body: str, source: str, keep: str) -> str:
    """st(keep, b, visible, signal, cjk, weird, marks, latin) of a text column."""
    each = ", ".join(f"length(regexp_replace(t, '[^{c}]', '', 'g')) AS {n}" for n, c in _CLASS.items())
    return rf"""st AS (SELECT *, length(t) AS visible, greatest(length(t), 1)::DOUBLE AS total, {each}, len(regexp_extract_all(b, '[A-Za-z]+|\d+')) AS latin FROM (SELECT {keep}, coalesce({body}, '') AS b, regexp_replace(coalesce({body}, ''), '{_SP}+', '', 'g') AS t FROM {source}))"""


@query("text_signal_ratios", f"""WITH {_signal_sql("text", "documents", "doc_id")} SELECT doc_id, visible, signal, cjk, round(signal / total, 6) AS signal_ratio, round(cjk / total, 6) AS cjk_ratio, round(latin / total, 6) AS latin_token_ratio, round(weird / total, 6) AS weird_ratio,
round(marks / total, 6) AS mojibake_marker_ratio, round((visible - signal) / total, 6) AS punctuation_ratio FROM st""")
def _(s, d):
    st = table(s, d, "documents", "doc_id", "text").select("doc_id", X.signal_stats("text").alias("s")).select("doc_id", "s.*")
    return st.select("doc_id", *[F.round(c, 6).alias(c) if c.endswith("_ratio") else c for c in st.columns if c != "doc_id"])


@query("stable_ids", "SELECT doc_id, printf('%s#chunk_%05d', doc_key, n_chars) AS cid, sha256(coalesce(text, '')) AS digest, substr(sha1(concat_ws('|', doc_key, source)), 1, 10) AS short FROM documents")
def _(s, d):
    x = table(s, d, "documents", "doc_id", "doc_key", "n_chars", "text", "source")
    return x.select("doc_id", R.chunk_id("doc_key", "n_chars").alias("cid"), R.sha256_text("text").alias("digest"), R.short_hash(F.col("doc_key"), F.col("source")).alias("short"))


@query("hash_bucket", "SELECT DISTINCT t, (('0x' || substr(sha1(t), 1, 8))::BIGINT % 384)::INT AS bucket, CASE WHEN ('0x' || substr(sha1(t), 9, 2))::BIGINT % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign FROM (SELECT unnest(regexp_extract_all(lower(text), '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[\\x{4e00}-\\x{9fff}]')) AS t FROM eval_items)")
def _(s, d):
    x = table(s, d, "eval_items").select(F.explode(X.tokens("text")).alias("t")).distinct()
    return x.select("t", R.bucket(F.col("t"), 384).alias("bucket"), R.sign(F.col("t")).alias("sign"))


@query("path_hint_source", r"""SELECT doc_id, coalesce(list_filter(list_transform(string_split(replace(markdown_clean_path, '\', '/'), '/'), lambda p: CASE regexp_replace(lower(p), '_pdf$', '') WHEN 'pdf' THEN 'scanned files' WHEN 'markdown_clean' THEN 'cleaned files' END), lambda v: v IS NOT NULL)[1], 'Unknown') AS hint FROM documents""")
def _(s, d):
    return table(s, d, "documents", "doc_id", "markdown_clean_path").select("doc_id", classify.source_by_path(F.col("markdown_clean_path"), HINTS).alias("hint"))


# -- ranking


def _ranks(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "rank_candidates").groupBy("query_id", F.col("chunk_id").alias("id")).agg(F.max("bm25_score").alias("bm25"), F.min("dense_distance").alias("dense"))
    a = fusion.rank_within(r.filter("bm25 IS NOT NULL"), ["query_id"], "id", F.col("bm25")).select("query_id", "id", F.lit("bm25").alias("channel"), "rank")
    b = fusion.rank_within(r.filter("dense IS NOT NULL"), ["query_id"], "id", -F.col("dense")).select("query_id", "id", F.lit("dense").alias("channel"), "rank")
    return a.unionByName(b)


RANKS_SQL = """r AS (SELECT query_id, chunk_id AS id, max(bm25_score) AS bm25, min(dense_distance) AS dense FROM rank_candidates GROUP BY ALL),
k AS (SELECT query_id, id, 'bm25' AS channel, row_number() OVER (PARTITION BY query_id ORDER BY bm25 DESC, id) AS rank FROM r WHERE bm25 IS NOT NULL UNION ALL SELECT query_id, id, 'dense', row_number() OVER (PARTITION BY query_id ORDER BY dense, id) FROM r WHERE dense IS NOT NULL)"""


@query("rank_channels", f"WITH {RANKS_SQL} SELECT query_id, id, channel, rank FROM k")
def _(s, d):
    return _ranks(s, d)


@query("rrf_fusion", f"WITH {RANKS_SQL} SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM k GROUP BY ALL")
def _(s, d):
    return fusion.rrf(_ranks(s, d), by=["query_id"])


@query("rrf_weighted", f"WITH {RANKS_SQL} SELECT query_id, id, round(sum(0.7::DOUBLE / (60 + rank)), 9) AS score FROM k WHERE channel = 'dense' GROUP BY ALL")
def _(s, d):
    return fusion.rrf(_ranks(s, d), weights={"bm25": 0.0, "dense": 0.7}, by=["query_id"])


@query("minmax_normalize", """WITH x AS (SELECT DISTINCT query_id, chunk_id, view_id, rerank_logit FROM rank_candidates WHERE rerank_logit IS NOT NULL), b AS (SELECT query_id, min(rerank_logit) AS lo, max(rerank_logit) AS hi FROM x GROUP BY ALL)
SELECT query_id, chunk_id, view_id, round(CASE WHEN hi > lo THEN (rerank_logit - lo) / (hi - lo) ELSE 1 / (1 + exp(-greatest(-50, least(50, rerank_logit)))) END, 6) AS norm FROM x JOIN b USING (query_id)""")
def _(s, d):
    x = table(s, d, "rank_candidates", "query_id", "chunk_id", "view_id", "rerank_logit").filter("rerank_logit IS NOT NULL").distinct()
    return fusion.minmax(x, "rerank_logit", "norm", by=["query_id"]).select("query_id", "chunk_id", "view_id", F.round("norm", 6).alias("norm"))


def _bm25_sql(where: str, k: int | None, terms: list[str], source: str = "ch", text: str = "concat_ws(' ', title, content)", id_: str = "chunk_id", extra: str = "") -> str:
    tf = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS f{i}" for i, w in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (WHERE f{i} > 0) AS d{i}" for i in range(len(terms)))
    score = " + ".join(f"CASE WHEN f{i} > 0 THEN ln(1 + (n - d{i} + 0.5::DOUBLE) / (d{i} + 0.5::DOUBLE)) * (f{i} * 2.2::DOUBLE) / (f{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * greatest(dl, 1) / greatest(avgdl, 1.0::DOUBLE))) ELSE 0 END" for i in range(len(terms)))
    some = " OR ".join(f"f{i} > 0" for i in range(len(terms)))
    return f"""tok AS (SELECT *, regexp_extract_all(lower({text}), '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[\\x{{4e00}}-\\x{{9fff}}]') AS t FROM {source}),
tf AS (SELECT *, len(t) AS dl, {tf} FROM tok), st AS (SELECT count(*) AS n, avg(dl) AS avgdl, {df} FROM tf),
hits AS (SELECT {id_}{extra}, round({score}, 6) AS score FROM tf, st WHERE ({some}){' AND ' + where if where else ''}{f' ORDER BY score DESC, {id_} LIMIT {k}' if k else ''})"""


def _text():
    return F.concat_ws(" ", "title", "content")


BM25_TERMS = ["telephone", "follow-up", "for", "chronic", "heart", "failure"]


@query("bm25_topk", f"WITH {CHUNKS_SQL}, {_bm25_sql('', 50, BM25_TERMS)} SELECT chunk_id, score FROM hits")
def _(s, d):
    return search.bm25(_raw(s, d, "title", "content"), QUERY, _text(), "chunk_id", 50, at="ingested_at").select("chunk_id", "score")


@query("bm25_filtered", f"WITH {CHUNKS_SQL}, {_bm25_sql('''document_kind = 'guideline' AND NOT is_reference_section''', 50, BM25_TERMS)} SELECT chunk_id, score FROM hits")
def _(s, d):
    only = F.coalesce((F.col("document_kind") == "guideline") & ~F.col("is_reference_section"), F.lit(False))
    return search.bm25(_raw(s, d, "title", "content", "document_kind", "is_reference_section"), QUERY, _text(), "chunk_id", 50, only=only, at="ingested_at").select("chunk_id", "score")


_BOOST_SQL = "CASE " + " ".join(f"WHEN chunk_type = '{t}' THEN {v}::DOUBLE" for t, v in BOOSTS.items()) + " ELSE 1.0 END"


@query("bm25_type_boost", f"WITH {CHUNKS_SQL}, {_bm25_sql('', 50, BM25_TERMS, extra=', chunk_type')} SELECT chunk_id, round(score * {_BOOST_SQL}, 6) AS score FROM hits ORDER BY score DESC, chunk_id LIMIT 10")
def _(s, d):
    x = search.bm25(_raw(s, d, "title", "content", "chunk_type"), QUERY, _text(), "chunk_id", None, keep=["chunk_type"], at="ingested_at")
    return fusion.boosted(x, "chunk_type", BOOSTS, 10, "chunk_id").select("chunk_id", "score")


@query("overfetch_dedup", f"""WITH {CHUNKS_SQL}, {_bm25_sql('', 60, BM25_TERMS, extra=', doc_id')} SELECT doc_id, max(score) AS score FROM hits GROUP BY doc_id ORDER BY score DESC, arg_min(chunk_id, (-score, chunk_id)) LIMIT 20""")
def _(s, d):
    x = search.bm25(_raw(s, d, "title", "content", "doc_id"), QUERY, _text(), "chunk_id", 60, keep=["doc_id"], at="ingested_at")
    return fusion.unique_documents(x.select("doc_id", "score", F.col("chunk_id").alias("id")), 20).select("doc_id", "score")


@query("quota_route", f"""WITH {CHUNKS_SQL}, {_bm25_sql('', 200, BM25_TERMS, extra=", CASE WHEN len(list_distinct(list_filter(string_split(coalesce(clinical_department, ''), '|'), lambda x: trim(x) != ''))) > 1 THEN 'compositive' ELSE 'single' END AS scope")},
q AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY score DESC, chunk_id) <= CASE scope WHEN 'single' THEN 91 ELSE 9 END AS i FROM hits), z AS (SELECT *, row_number() OVER (ORDER BY i DESC, score DESC, chunk_id) AS pos FROM q) SELECT chunk_id, scope, score FROM z WHERE pos <= 100""")
def _(s, d):
    x = search.bm25(_raw(s, d, "title", "content", "clinical_department"), QUERY, _text(), "chunk_id", 200, keep=["clinical_department"], at="ingested_at")
    x = x.withColumn("scope", R.department_fields("clinical_department")["scope"])
    return fusion.quota(x, "scope", [F.desc("score"), F.col("chunk_id")], {"single": 91, "compositive": 9}, 100).select("chunk_id", "scope", "score")


@query("fallback_union", f"""WITH {CHUNKS_SQL}, {_bm25_sql('', 60, BM25_TERMS, extra=', document_kind')}, g AS (SELECT chunk_id, score, false AS is_fallback, row_number() OVER (ORDER BY score DESC, chunk_id) AS r FROM hits WHERE document_kind = 'consensus'),
c AS (SELECT chunk_id, score, true AS is_fallback, row_number() OVER (ORDER BY score DESC, chunk_id) AS r FROM hits WHERE document_kind = 'guideline') SELECT chunk_id, score, is_fallback FROM g WHERE r <= 25 UNION ALL SELECT chunk_id, score, is_fallback FROM c WHERE r <= 25 - (SELECT count(*) FROM g WHERE r <= 25)""")
def _(s, d):
    x = search.bm25(_raw(s, d, "title", "content", "document_kind"), QUERY, _text(), "chunk_id", 60, keep=["document_kind"], at="ingested_at")
    a, b = (x.filter(F.col("document_kind") == k).select("chunk_id", "score") for k in ("consensus", "guideline"))
    return fusion.fallback(a, b, [F.desc("score"), F.col("chunk_id")], 25, "chunk_id").select("chunk_id", "score", "is_fallback")


@query("dense_cosine_topk", f"WITH q AS (SELECT {VECTOR!r}::DOUBLE[] AS v) SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], v) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(v, v))), 6) AS score FROM embeddings, q ORDER BY score DESC, vec_id LIMIT 50")
def _(s, d):
    return search.dense_topk(search.check_dimension(table(s, d, "embeddings"), "embedding", 64), VECTOR, "embedding", "vec_id", 50)


@query("quality_multiplier", r"""SELECT doc_id, ingested_at, round(1 - least(0.55, CASE q WHEN 'poor' THEN 0.28 WHEN 'warning' THEN 0.08 ELSE 0 END + CASE p WHEN 'poor' THEN 0.24 WHEN 'warning' THEN 0.08 ELSE 0 END + CASE WHEN n IN ('1', 'true', 'yes', 'y') THEN 0.18 ELSE 0 END
+ CASE WHEN s IN ('needed_unavailable', 'needed_not_applied', 'needed_but_disabled', 'failed') THEN 0.24 WHEN s = 'applied_needs_review' THEN 0.14 ELSE 0 END
+ CASE WHEN list_has_any(f, ['likely_ocr_failure', 'low_text_signal', 'noisy_ocr_lines', 'pdf_text_mojibake']) THEN 0.18 ELSE 0 END + CASE WHEN list_contains(f, 'noisy_ocr_title') THEN 0.10 ELSE 0 END)::DOUBLE, 4) AS multiplier
FROM (SELECT doc_id, ingested_at, lower(trim(coalesce(cleaning_quality, ''))) AS q, lower(trim(coalesce(pdf_text_quality, ''))) AS p, lower(trim(coalesce(pdf_needs_ocr, ''))) AS n, lower(trim(coalesce(ocr_status, ''))) AS s,
list_transform(regexp_split_to_array(lower(coalesce(cleaning_flags, '')), '[,;]\s*'), lambda x: trim(x)) AS f FROM document_cards)""")
def _(s, d):
    return table(s, d, "document_cards").select("doc_id", "ingested_at", rerank.quality_multiplier().alias("multiplier"))


@query("rule_rerank_chunk", f"""WITH {CHUNKS_SQL}, {_bm25_sql('', 50, BM25_TERMS, extra=", title, content, chunk_type, is_reference_section, token_count, array_to_string(section_path, ' > ') AS path")},
z AS (SELECT *, lower(coalesce(content, '')) AS c, lower(coalesce(title, '')) AS ti, lower(coalesce(path, '')) AS pa FROM hits),
o AS (SELECT *, ({' + '.join(f"(CASE WHEN contains(c, '{w}') THEN 1 ELSE 0 END)" for w in BM25_TERMS)}) AS n FROM z)
SELECT chunk_id, round(score * (1 + CASE WHEN contains(c, '{QUERY}') THEN 0.36 ELSE 0 END + CASE WHEN n > 0 THEN least(0.26, 0.08 + n / 6.0::DOUBLE * 0.22) ELSE 0 END + CASE WHEN {' OR '.join(f"contains(pa, '{w}')" for w in BM25_TERMS)} THEN 0.12 ELSE 0 END
+ CASE WHEN {' OR '.join(f"contains(ti, '{w}')" for w in BM25_TERMS)} THEN 0.08 ELSE 0 END + CASE chunk_type WHEN 'recommendation' THEN 0.18 WHEN 'key_message' THEN 0.14 WHEN 'pico' THEN 0.12 WHEN 'algorithm' THEN 0.10 WHEN 'evidence' THEN 0.06 WHEN 'table' THEN 0.05 ELSE 0 END)
* greatest(0.05, 1 - least(0.9, CASE WHEN is_reference_section THEN 0.75 ELSE 0 END + CASE WHEN regexp_matches(pa, 'references?|bibliography|参考文献') THEN 0.35 ELSE 0 END)), 6) AS score FROM o ORDER BY score DESC, token_count DESC, chunk_id LIMIT 20""")
def _(s, d):
    keep = ["title", "content", "chunk_type", "is_reference_section", "token_count", "section_path"]
    raw = _raw(s, d, *keep)
    x = search.payload(search.bm25(raw, QUERY, _text(), "chunk_id", 50, at="ingested_at"), raw, "chunk_id", keep, "ingested_at")
    return rerank.rule_chunks(x, QUERY, 20).select("chunk_id", "score")


# -- classification


@query("label_scores", """SELECT doc_id, label, sum(s) AS score FROM (SELECT doc_id, r.label, CASE WHEN CASE WHEN r.k ~ '[\\x{4e00}-\\x{9fff}]' THEN contains(t, r.k) ELSE regexp_matches(' ' || t || ' ', '[^a-z0-9]' || r.k || '[^a-z0-9]') END THEN r.bonus ELSE 0 END + CASE WHEN CASE WHEN r.k ~ '[\\x{4e00}-\\x{9fff}]' THEN contains(b, r.k) ELSE regexp_matches(' ' || b || ' ', '[^a-z0-9]' || r.k || '[^a-z0-9]') END THEN r.weight ELSE 0 END AS s
FROM (SELECT doc_id, lower(coalesce(title, '')) AS t, lower(coalesce(text, '')) AS b FROM documents), (VALUES %s) r(label, k, bonus, weight)) GROUP BY ALL HAVING sum(s) > 0""".replace("%s", ", ".join(f"('{a}', '{k}', {b}.0::DOUBLE, {w}.0::DOUBLE)" for a, k, b, w in DEPARTMENTS)))
def _(s, d):
    x = spread(table(s, d, "documents", "doc_id", "title", "text"))
    return classify.keyword_scores(x, "doc_id", F.col("title"), F.col("text"), DEPARTMENTS).select("doc_id", "label", "score")


_POSITIONS = ", ".join(f"('{x}', {i})" for i, x in enumerate(dict.fromkeys(r[0] for r in DEPARTMENTS)))


@query("label_multi_threshold", f"""WITH sc AS ({SQL["label_scores"]}), x AS (SELECT sc.*, p.i, max(score) OVER (PARTITION BY doc_id) AS top, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, p.i) AS r, max(score) OVER (PARTITION BY doc_id) >= greatest(2.0, max(score) OVER (PARTITION BY doc_id) * 0.35) AS any_kept FROM sc JOIN (VALUES {_POSITIONS}) p(label, i) USING (label))
SELECT doc_id, list(label ORDER BY score DESC, i) AS labels FROM x WHERE score >= greatest(2.0, top * 0.35) OR (NOT any_kept AND r = 1) GROUP BY doc_id""")
def _(s, d):
    x = spread(table(s, d, "documents", "doc_id", "title", "text"))
    return classify.labels(classify.keyword_scores(x, "doc_id", F.col("title"), F.col("text"), DEPARTMENTS), "doc_id")


TITLE_RULES = (("respiratory", "asthma|pneumonia|哮喘|肺炎"), ("cardiology", "heart failure|hypertension|心力衰竭|高血压"), ("nephrology", "kidney|renal|肾"), ("endocrinology", "diabetes|gout|糖尿病|痛风"))


@query("title_labels", f"""WITH x AS (SELECT doc_id, trim(translate(coalesce(title, ''), '０１２３４５６７８９', '0123456789')) AS t FROM documents), y AS (SELECT doc_id, t = '' OR regexp_matches(t, '{metadata.ARTIFACTS}') AS generic,
list_filter([{", ".join(f"CASE WHEN regexp_matches(t, '(?i){p}') THEN '{x}' END" for x, p in TITLE_RULES)}], lambda v: v IS NOT NULL) AS hits FROM x)
SELECT doc_id, CASE WHEN generic THEN [] ELSE hits END AS labels, CASE WHEN generic THEN 'artifact_or_generic_title' WHEN len(hits) > 0 THEN 'title_rule' ELSE 'no_precise_signal' END AS reason FROM y""")
def _(s, d):
    return table(s, d, "documents", "doc_id", "title").select("doc_id", metadata.title_labels(F.col("title"), TITLE_RULES).alias("l")).select("doc_id", "l.*")


def _labels_sql(x: str) -> str:
    each = f"list_filter(list_transform(string_split(coalesce({x}, ''), '|'), lambda v: trim(v)), lambda v: v != '')"
    return f"list_filter({each}, lambda v, i: list_position({each}, v) = i)"


@query("relabelled_chunks", f"""WITH {DOCS_SQL}, {CHUNKS_SQL}, x AS (SELECT chunk_id, {_labels_sql("ch.clinical_department")} AS own, {_labels_sql("docs.clinical_department")} AS parent FROM ch JOIN docs USING (doc_id))
SELECT chunk_id, CASE WHEN own = ['未分类'] AND NOT list_contains(parent, '未分类') THEN parent[1:1] WHEN len(own) > 0 AND len(list_filter(own, lambda v: NOT list_contains(parent, v))) = 0 THEN own ELSE [coalesce(parent[1], '未分类')] END AS labels FROM x""")
def _(s, d):
    """Nothing is found anew here, so that labels that a document lacks give way to its first."""
    x = _chunks(s, d, "chunk_id", "doc_id", "clinical_department").select("chunk_id", "doc_id", F.col("clinical_department").alias("own"))
    x = x.join(_docs(s, d).select("doc_id", F.col("clinical_department").alias("parent")), "doc_id")
    none = F.array().cast("array<string>")
    return x.select("chunk_id", metadata.relabelled(metadata.labels_of(F.col("own")), metadata.labels_of(F.col("parent")), none).alias("labels"))


@query("titles_found")
def _(s, d):
    """Titles made anew from bodies and file names, beside the stored ones."""
    x = spread(table(s, d, "documents", "doc_id", "title", "content_md", "source_file"))
    return x.select("doc_id", "title", metadata.find_title(F.col("content_md"), F.col("source_file")).alias("found"))


@query("title_changes", """SELECT doc_id, 'title' AS field, title AS before, trim(regexp_replace(coalesce(title, ''), '[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{0b}]+', ' ', 'g')) AS after FROM documents WHERE after IS DISTINCT FROM title""")
def _(s, d):
    """A dry run: what squeezing titles would change."""
    x = table(s, d, "documents", "doc_id", "title")
    return metadata.changes(x, x.withColumn("title", X.squeeze("title")), "doc_id", ["title"])


@query("change_counts", f"SELECT 'title' AS field, count(*) AS n FROM ({SQL['title_changes']}) HAVING count(*) > 0")
def _(s, d):
    return metadata.change_report(QUERIES["title_changes"](s, d), "doc_id")[0]


@query("change_examples", f"SELECT *, row_number() OVER (ORDER BY doc_id)::INT AS example FROM ({SQL['title_changes']}) QUALIFY example <= 8")
def _(s, d):
    return metadata.change_report(QUERIES["title_changes"](s, d), "doc_id")[1]


@query("readable_ratios", rf"SELECT doc_id, CASE WHEN length(t) = 0 THEN 0 ELSE round(length(regexp_replace(t, '[^\p{{L}}\p{{N}}，。；：、“”‘’（）《》.,;:!?()/%\-]', '', 'g')) / length(t)::DOUBLE, 6) END AS ratio FROM (SELECT doc_id, regexp_replace(coalesce(abstract, ''), '{_SP}+', '', 'g') AS t FROM documents)")
def _(s, d):
    return table(s, d, "documents", "doc_id", "abstract").select("doc_id", F.round(X.readable_ratio("abstract"), 6).alias("ratio"))


@query("sources_found", """WITH x AS (SELECT doc_id, lower(replace(coalesce(source_file, ''), chr(92), '/')) AS p, lower(concat_ws(chr(10), regexp_split_to_array(coalesce(source_file, ''), '[/\\\\]')[-1], title, regexp_split_to_array(coalesce(text, ''), '(?i)摘要|提要|\\babstract\\b|\\bsummary\\b')[1])) AS h FROM documents),
y AS (SELECT doc_id, list_filter(list_transform(list_filter(string_split(p, '/'), lambda v: v NOT IN ('raw_pdf', 'consensus', 'pdfs', 'documents', 'pages')), lambda v: CASE v WHEN 'pdf' THEN 'scanned files' WHEN 'markdown_clean' THEN 'cleaned files' ELSE CASE WHEN ends_with(v, '_pdf') AND length(v) > 4 THEN left(v, length(v) - 4) END END), lambda v: v IS NOT NULL)[1] AS n, regexp_matches(p, '(?:^|/)consensus(?:/|$)') AS c, h FROM x)
SELECT doc_id, CASE WHEN n IS NOT NULL THEN n WHEN c THEN 'Unknown' WHEN contains(h, 'council') THEN 'a council' WHEN contains(h, 'registry') OR contains(h, 'register') THEN 'a registry' ELSE 'Unknown' END AS source FROM y""")
def _(s, d):
    x = spread(table(s, d, "documents", "doc_id", "title", "text", "source_file"))
    by = metadata.source_institution(F.col("source_file"), F.col("title"), F.col("text"), hints=HINTS, patterns=(("a council", ("council",)), ("a registry", ("registry", "register"))))
    return x.select("doc_id", by.alias("source"))


@query("section_types")
def _(s, d):
    x = spread(table(s, d, "sections", "section_id", "heading", "section_path", "content"))
    t = classify.section_type(F.col("heading"), F.col("section_path"), F.col("content"))
    return x.select("section_id", t.alias("section_type"), classify.type_weight(t).alias("weight"))


# -- windows and links


@query("prev_next_links", f"WITH {CHUNKS_SQL} SELECT chunk_id, lag(chunk_id) OVER w AS prev_id, lead(chunk_id) OVER w AS next_id FROM ch WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index, chunk_id)")
def _(s, d):
    return chunking.neighbours(_chunks(s, d, "chunk_id", "doc_id", "chunk_index").select("chunk_id", "doc_id", "chunk_index"), "doc_id", "chunk_index", "chunk_id").select("chunk_id", "prev_id", "next_id")


@query("same_section_links", f"WITH {CHUNKS_SQL}, p AS (SELECT chunk_id, doc_id, section_path, row_number() OVER (PARTITION BY doc_id, section_path ORDER BY chunk_index, chunk_id) AS i FROM ch) SELECT a.chunk_id AS source, b.chunk_id AS target FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.section_path = b.section_path AND b.i BETWEEN a.i + 1 AND a.i + 5")
def _(s, d):
    return chunking.same_section_links(_chunks(s, d, "chunk_id", "doc_id", "section_path", "chunk_index").select("chunk_id", "doc_id", "section_path", "chunk_index"), ["doc_id", "section_path"], "chunk_index", "chunk_id")


@query("heading_islands", f"WITH {CHUNKS_SQL}, c AS (SELECT chunk_id, doc_id, chunk_index, CASE WHEN section_path = lag(section_path) OVER w THEN 0 ELSE 1 END AS c FROM ch WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index, chunk_id)) SELECT chunk_id, sum(c) OVER (PARTITION BY doc_id ORDER BY chunk_index, chunk_id)::BIGINT AS island FROM c")
def _(s, d):
    x = _chunks(s, d, "chunk_id", "doc_id", "chunk_index", "section_path").select("chunk_id", "doc_id", "chunk_index", F.array_join("section_path", " > ").alias("path"))
    return chunking.islands(x.withColumn("o", F.struct("chunk_index", "chunk_id")), "doc_id", "o", "path").select("chunk_id", "island")


@query("repeated_lines")
def _(s, d):
    return cleaning.repeated_lines(spread(table(s, d, "documents", "doc_id", "content_md")), "doc_id", "content_md")


# -- parsing, cleaning, building: checked in the tests


SECTIONS_SQL = rf"""seg AS (SELECT doc_id, unnest(s) AS seg, generate_subscripts(s, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(coalesce(content_md, ''), '(?m)^(#{{1,6}}{_BL}+[^\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}][^\r\n]*)', chr(1) || '\1', 'g'), chr(1)) AS s FROM documents)),
pos AS (SELECT *, coalesce(sum(length(seg)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS a, count(*) OVER (PARTITION BY doc_id) AS n FROM seg),
hd AS (SELECT doc_id, i, seg, a, (a + length(seg))::INT AS b, CASE WHEN i = 1 THEN 1 ELSE length(regexp_extract(seg, '^#+')) END AS level, CASE WHEN i > 1 THEN {_strip("regexp_extract(seg, '^#+([^\r\n]*)', 1)")} WHEN n > 1 THEN 'Preface' ELSE 'Document' END AS heading FROM pos WHERE i > 1 OR n = 1 OR {_strip('seg')} != ''),
up AS (SELECT x.doc_id, x.i, list(y.heading ORDER BY y.i) AS path FROM hd x JOIN hd y ON x.doc_id = y.doc_id AND (y.i = x.i OR y.i > 1 AND y.i < x.i AND NOT EXISTS (SELECT 1 FROM hd z WHERE z.doc_id = y.doc_id AND z.i > y.i AND z.i <= x.i AND z.level <= y.level)) GROUP BY ALL),
sections_ AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS section_index, path AS section_path, heading, level::INT AS heading_level, a AS char_start, b AS char_end, {_strip('seg')} AS content FROM hd JOIN up USING (doc_id, i))"""
REFERENCE_SQL = r"heading != 'Preface' AND (len(list_filter(section_path, lambda p: lower(p) IN ('references', 'bibliography', '参考文献'))) > 0 OR regexp_matches(content, '(?i)<!--\s*reference_section:\s*true\s*-->|(?:^|\n)\s*(?:#{1,6}\s*)?(?:REFERENCES|BIBLIOGRAPHY|参考文献)\s*\n\s*(?:\d+\.|\[\d+\])'))"
BLOCKS_SQL = rf"""ln AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS i FROM (SELECT doc_id, regexp_split_to_array(content_md, '\r\n|\r|\n') AS s FROM documents WHERE content_md IS NOT NULL)),
kd AS (SELECT *, CASE WHEN regexp_matches(line, '(?i)<!--\s*page:\s*\d+\s*-->|^{_BL}*\[page\s+\d+\]{_BL}*$|^{_BL}*page\s+\d+{_BL}*$') THEN 'page' WHEN regexp_matches(line, '^#{{1,5}}{_BL}+[^\s\x{{a0}}\x{{3000}}]') THEN 'heading'
  WHEN regexp_matches(line, '^{_BL}*\|(.*\|)?{_BL}*$') THEN 'table' WHEN {_strip('line')} = '' THEN 'blank' ELSE 'text' END AS kind FROM ln),
st AS (SELECT *, CASE WHEN kind IN ('page', 'heading') OR kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY doc_id ORDER BY i) THEN 1 ELSE 0 END AS s FROM kd),
gr AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY i) AS g, last_value(CASE WHEN kind = 'page' THEN regexp_extract(line, '(?i)page:?\s*(\d+)', 1)::INT END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS page FROM st),
bl AS (SELECT doc_id, g, any_value(kind) AS kind, any_value(page) AS page, {_strip("string_agg(line, chr(10) ORDER BY i)")} AS t FROM gr WHERE kind NOT IN ('page', 'blank') GROUP BY doc_id, g)"""


@query("parse_sections", f"WITH {SECTIONS_SQL} SELECT *, {REFERENCE_SQL} AS is_reference_section FROM sections_")
def _(s, d):
    return markdown.parse_sections(spread(table(s, d, "documents", "doc_id", "content_md")), "content_md", "doc_id")


def _blocks(s, d):
    return markdown.parse_blocks(spread(table(s, d, "documents", "doc_id", "content_md")), "content_md", "doc_id")


@query("parse_blocks", f"WITH {BLOCKS_SQL} SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1)::INT AS order_index, kind, CASE WHEN kind = 'heading' THEN {_strip("regexp_replace(t, '^#+', '')")} ELSE t END AS text, page FROM bl")
def _(s, d):
    return _blocks(s, d).select("doc_id", "order_index", "kind", F.regexp_replace("text", r"\r\n?", "\n").alias("text"), "page")


@query("block_types")
def _(s, d):
    return _blocks(s, d).select("doc_id", "order_index", "heading_path", "level", "char_start", "char_end", "note", "block_type")


def _cells_sql(x: str) -> str:
    return rf"list_transform(string_split(regexp_replace(trim({x}), '^\|+|\|+$', '', 'g'), '|'), lambda c: trim(c))"


@query("table_chunks", rf"""WITH {BLOCKS_SQL}, nb AS (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1)::INT AS order_index FROM bl),
tb AS (SELECT doc_id, order_index, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x != '') AS l FROM nb WHERE kind = 'table'),
hd AS (SELECT *, CASE WHEN len(l) >= 2 AND len(list_filter({_cells_sql('l[2]')}, lambda c: NOT regexp_matches(replace(c, ':', ''), '^-{{3,}}$'))) = 0 THEN {_cells_sql('l[1]')} END AS headers FROM tb),
rw AS (SELECT doc_id, order_index, headers, CASE WHEN headers IS NOT NULL THEN list_filter(l[3:], lambda x: starts_with(x, '|') AND ends_with(x, '|')) END AS r FROM hd),
ex AS (SELECT doc_id, order_index, unnest(r) AS line, generate_subscripts(r, 1) AS i FROM rw)
SELECT rw.doc_id, rw.order_index, rw.headers, (i - 1)::INT AS row_index, list_resize({_cells_sql('line')}, len(headers), '') AS cells, CASE WHEN headers IS NULL THEN 'table_header_not_parsed' END AS warning FROM rw LEFT JOIN ex USING (doc_id, order_index)""")
def _(s, d):
    return markdown.table_chunks(_blocks(s, d), "doc_id").select("doc_id", "order_index", "headers", "row_index", "cells", "warning")


@query("atomic_chunks")
def _(s, d):
    return chunking.atomic_chunks(_blocks(s, d), "doc_id")


@query("section_chunks")
def _(s, d):
    return chunking.section_chunks(spread(table(s, d, "documents", "doc_id", "title", "content_md")), "content_md", "title", "doc_id")


@query("semantic_chunks")
def _(s, d):
    """Of the sections delivered; of those delivered again each gives the same parts, so that only keys are compared."""
    x = spread(table(s, d, "sections", "section_id", "doc_id", "section_index", "heading", "section_path", "content", "is_reference_section", "ingested_at"))
    return chunking.chunk_sections(ingest.last_delivery(x, ["section_id"], "ingested_at"), "section_id", "doc_id", "section_index")


@query("chunk_documents")
def _(s, d):
    return chunking.chunk_documents(spread(table(s, d, "documents", "doc_id", "title", "content_md")), "content_md", "title", "doc_id")


def _low_sql(x: str) -> str:
    few = f"CASE WHEN regexp_matches({x}, '{_SIGNS_SQL}') THEN length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g')) < 6 OR length(regexp_replace({x}, '{_SP}|[\\p{{L}}\\p{{N}}]', '', 'g')) / length({x})::DOUBLE > 0.25 ELSE length(regexp_replace({x}, '{_SP}', '', 'g')) >= 12 AND length(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]', '', 'g')) / length(regexp_replace({x}, '{_SP}', '', 'g'))::DOUBLE < 0.25 END"
    title = f"trim(regexp_replace({x}, '^#{{1,6}}(?:\\s+|$)', ''))"
    n = f"length(regexp_replace({title}, '[^\\p{{L}}]', '', 'g'))"
    return f"({x} != '' AND NOT regexp_matches({x}, '^#{{1,6}}\\s+') AND ({few})) OR (regexp_matches({x}, '^#{{1,6}}(?:\\s|$)') AND ({n} = 0 OR (regexp_matches({title}, '{_SIGNS_SQL}') AND {n} < 6)))"


_SIGNS_SQL = cleaning.SIGNS_LINE.replace("'", "''").replace("\\s", r"\s\x0b")
_ASSESS_SQL = rf"""WITH {_signal_sql("content_md", "documents", "doc_id")},
f AS (SELECT *, signal / total AS sr, (len(regexp_extract_all(b, '_{{3,}}')) >= 5 AND len(regexp_extract_all(b, '(?i)\b(?:date|time|name|notes?|score|pain|headache|medication|yes|no)\b')) >= 3) OR (len(regexp_extract_all(b, '_{{3,}}')) >= 12 AND length(regexp_replace(t, '[^_]', '', 'g')) / total > 0.12) AS form,
  len(list_filter(list_transform(string_split(b, chr(10)), lambda x: trim(x)), lambda x: {_low_sql("x")})) AS noisy, regexp_extract_all(b, '[A-Za-z]+|\d+') AS ts FROM st),
g AS (SELECT *, visible >= 1000 AND NOT form AND (weird / total > 0.12 OR (sr < 0.55 AND (visible - signal) / total > 0.45) OR (sr < 0.6 AND cjk / total < 0.05 AND marks / total > 0.008)) AS garbled,
  len(ts) >= 40 AND len(list_filter(ts, lambda t: regexp_matches(t, '^(?:[A-Za-z]|\d+)$'))) / greatest(len(ts), 1)::DOUBLE > 0.45 AND len(list_filter(ts, lambda t: length(t) >= 4 AND regexp_matches(t, '[aeiouAEIOU]'))) / greatest(len(ts), 1)::DOUBLE < 0.18 AS apart FROM f),
h AS (SELECT *, list_filter([CASE WHEN visible < 300 THEN 'very_short_text' END, CASE WHEN sr < 0.45 AND NOT form THEN 'low_text_signal' END, CASE WHEN NOT form AND (noisy >= 2 OR (visible < 500 AND noisy >= 1)) THEN 'noisy_ocr_lines' END,
  CASE WHEN NOT garbled AND NOT form AND cjk = 0 AND visible > 300 AND (sr < 0.6 OR apart) THEN 'likely_ocr_failure' END, CASE WHEN garbled THEN 'pdf_text_mojibake' END, CASE WHEN garbled THEN 'likely_ocr_failure' END,
  CASE WHEN regexp_matches(b, '{cleaning.JOURNAL}') THEN 'journal_header_residue' END, CASE WHEN regexp_matches(b, '{cleaning.DOI}') THEN 'doi_residue' END, CASE WHEN regexp_matches(b, '{cleaning.EMAIL}') THEN 'email_residue' END,
  CASE WHEN regexp_matches(b, '{cleaning.PAGE_LINE}') THEN 'page_marker_residue' END, CASE WHEN regexp_matches(b, '[\x{{fffd}}\x{{25a0}}\x{{25a1}}\x{{25aa}}\x{{e000}}-\x{{f8ff}}]') THEN 'bad_glyph_residue' END], lambda x: x IS NOT NULL) AS flags FROM g)
SELECT doc_id, flags, CASE WHEN list_has_any(flags, ['low_text_signal', 'likely_ocr_failure', 'noisy_ocr_lines']) THEN 'poor' WHEN len(flags) > 0 THEN 'warning' ELSE 'ok' END AS quality, round(sr, 3) AS signal_ratio, visible FROM h"""


def _structural(s, d):
    x = spread(table(s, d, "documents", "doc_id", "title", "content_md"))
    return structural.structural_chunks(x, "content_md", "title", "doc_id")


@query("structural_chunks")
def _(s, d):
    return _structural(s, d)


@query("structural_search")
def _(s, d):
    """The chunks are made once, in the shared folder, as an index is."""
    return structural.search(cut(_structural(s, d)), QUERY, 10).select("chunk_id", "chunk_type", "score")


@query("assess_bodies", _ASSESS_SQL)
def _(s, d):
    return cleaning.assess(spread(table(s, d, "documents", "doc_id", "content_md")), "content_md").drop("content_md")


@query("clean_bodies")
def _(s, d):
    x = spread(table(s, d, "documents", "doc_id", "content_md")).select("doc_id", cleaning.cleaned("content_md").alias("body"))
    return cleaning.assess(x, "body")


@query("document_cards_built")
def _(s, d):
    x = spread(table(s, d, "documents")).drop("doc_id").withColumnRenamed("doc_key", "doc_id")
    return views.contract(views.cards(x), views.CARD_FIELDS)


@query("document_views_built")
def _(s, d):
    x = spread(table(s, d, "documents")).drop("doc_id").withColumnRenamed("doc_key", "doc_id")
    return views.contract(views.views(views.cards(x)), views.VIEW_FIELDS)


@query("front_matter_round_trip")
def _(s, d):
    x = spread(table(s, d, "documents"))
    header = F.create_map(*[y for k in ("title", "publication_date", "document_kind") for y in (F.lit(k), F.coalesce(F.col(k), F.lit("")))])
    md = files.dump_front_matter(header, F.coalesce("content_md", F.lit("")))
    p = x.select("doc_id", files.parse_front_matter(md).alias("p"))
    return p.select("doc_id", F.col("p.header")["publication_date"].alias("publication_date"), F.length("p.body").alias("n"))


def _tok(x: str) -> str:
    return rf"regexp_extract_all(lower(coalesce({x}, '')), '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[\x{{4e00}}-\x{{9fff}}]')"


def _lex_sql(name: str, source: str, id_: str, fields: list[tuple[str, str]], any_of: list[list[str]], where: str, extra: str = "") -> str:
    """name(id, extra, score) of rows of source that match, by cover density."""
    ts = "[]::VARCHAR[]"
    ws = "[]::DOUBLE[]"
    for f, c in fields:
        ts, ws = f"list_concat({ts}, {_tok(f)})", f"list_concat({ws}, list_transform({_tok(f)}, lambda x: {search.WEIGHTS[c]}::DOUBLE))"
    words = [w for of in any_of for w in of]
    ends = ", ".join(f"CASE WHEN count(*) FILTER (WHERE t IN ({', '.join(map(repr, of))})) = {len(of)} THEN max(m) FILTER (WHERE t IN ({', '.join(map(repr, of))})) END" for of in any_of)
    return f"""{name}_t AS (SELECT {id_} AS id{extra}, {ts} AS ts, {ws} AS ws FROM {source}), {name}_m AS (SELECT *, ' ' || array_to_string(ts, ' ') || ' ' AS j FROM {name}_t WHERE len(ts) > 0),
{name}_r AS (SELECT * FROM {name}_m WHERE {where}), {name}_u AS (SELECT id, unnest(ts) AS t, unnest(ws) AS w, generate_subscripts(ts, 1) AS p FROM {name}_r), {name}_o AS (SELECT * FROM {name}_u WHERE t IN ({", ".join(f"'{w}'" for w in words)})),
{name}_f AS (SELECT a.id, a.p, b.t, min(b.p) AS m FROM {name}_o a JOIN {name}_o b ON a.id = b.id AND b.p >= a.p GROUP BY ALL), {name}_e AS (SELECT * FROM (SELECT id, p AS q, list_min([{ends}]) AS e FROM {name}_f GROUP BY id, p)),
{name}_l AS (SELECT * FROM (SELECT *, lead(e) OVER (PARTITION BY id ORDER BY q) AS nx FROM {name}_e) WHERE e IS NOT NULL AND nx IS DISTINCT FROM e),
{name}_c AS (SELECT l.id, l.q, count(*) / sum(1 / w) / (1 + l.e - l.q + 1 - count(*)) AS c FROM {name}_l l JOIN {name}_o o ON o.id = l.id AND o.p BETWEEN l.q AND l.e GROUP BY l.id, l.q, l.e),
{name} AS (SELECT r.* EXCLUDE (ts, ws, j), round(coalesce(s, 0), 6) AS score FROM {name}_r r LEFT JOIN (SELECT id, sum(c) AS s FROM {name}_c GROUP BY id) USING (id))"""


def _dense_sql(name: str, source: str, id_: str, text: str, query: str = QUERY, extra: str = "") -> str:
    """name(id, extra, score) of all rows of source, by the hashing encoder."""
    q = ", ".join(f"({i}, {v!r}::DOUBLE)" for i, v in enumerate(R.hash_vector(query)) if v)
    return f"""{name}_u AS (SELECT {id_} AS id, unnest({_tok(text)}) AS t FROM {source}), {name}_w AS (SELECT t, ('0x' || substr(sha1(t), 1, 8))::BIGINT % 384 AS b, CASE WHEN ('0x' || substr(sha1(t), 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS s FROM (SELECT DISTINCT t FROM {name}_u)),
{name}_v AS (SELECT id, b, sum(s)::DOUBLE AS v FROM {name}_u JOIN {name}_w USING (t) GROUP BY ALL), {name}_s AS (SELECT id, CASE WHEN sum(v * v) > 0 THEN sum(v * coalesce(q, 0)) / sqrt(sum(v * v)) ELSE 0 END AS s FROM {name}_v LEFT JOIN (VALUES {q}) x(b, q) USING (b) GROUP BY id),
{name} AS (SELECT {id_} AS id{extra}, round(coalesce(s, 0), 6) AS score FROM {source} c LEFT JOIN {name}_s s ON s.id = c.{id_})"""


_LAST_SQL = """cd AS (SELECT DISTINCT ON (doc_id) * FROM document_cards ORDER BY doc_id, ingested_at DESC), vw AS (SELECT DISTINCT ON (view_id) * FROM document_views ORDER BY view_id, ingested_at DESC)"""
_ALL_OF = " AND ".join(f"list_contains(ts, '{w}')" for w in dict.fromkeys(BM25_TERMS))
#: A retrieval text, as chunks are indexed by it.
_RETRIEVAL_SQL = "concat_ws(chr(10), nullif(trim(title), ''), nullif(array_to_string(section_path, ' > '), ''), CASE WHEN chunk_type != '' THEN 'chunk_type: ' || chunk_type END, CASE WHEN trim(content) != '' THEN content END)"


def _top_sql(name: str, k: int) -> str:
    return f"SELECT id, '{name}' AS channel, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (SELECT id, score FROM {name} WHERE id IN (SELECT doc_id FROM docs) ORDER BY score DESC, id LIMIT {k})"


def _best_view_sql(name: str, k: int) -> str:
    return f"SELECT doc_id AS id, '{name}' AS channel, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM (SELECT doc_id, max(score) AS score, arg_min(id, (-score, id)) AS i FROM (SELECT * FROM {name} WHERE doc_id IN (SELECT doc_id FROM docs) ORDER BY score DESC, id LIMIT {3 * k}) GROUP BY doc_id ORDER BY score DESC, i LIMIT {k})"


HYBRID_SQL = f"""WITH {DOCS_SQL}, {_LAST_SQL},
{_lex_sql("ct", "cd", "doc_id", [("title", "A"), ("clinical_department", "B"), ("card_text", "C")], [list(dict.fromkeys(BM25_TERMS))], _ALL_OF)},
{_lex_sql("vt", "vw", "view_id", [("title", "A"), ("view_type", "B"), ("clinical_department", "B"), ("text", "C")], [list(dict.fromkeys(BM25_TERMS))], _ALL_OF, ", doc_id")},
{_dense_sql("cv", "cd", "doc_id", "card_text")}, {_dense_sql("vv", "vw", "view_id", "text", extra=", doc_id")},
ranks AS ({_top_sql("ct", 50)} UNION ALL {_best_view_sql("vt", 50)} UNION ALL {_top_sql("cv", 50)} UNION ALL {_best_view_sql("vv", 50)}),
fused AS (SELECT id AS doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS base_score FROM ranks GROUP BY id), cand AS (SELECT * FROM fused JOIN docs USING (doc_id) ORDER BY base_score DESC, doc_id LIMIT 40),
z AS (SELECT *, lower(coalesce(title, '')) AS t FROM cand)
SELECT doc_id, title, base_score, round(boost, 6) AS boost, round(base_score * (1 + boost), 6) AS score FROM (SELECT *, CASE WHEN {' OR '.join(f"contains(t, '{w}')" for w in BM25_TERMS)} THEN 0.20 ELSE 0 END::DOUBLE + CASE WHEN contains(t, '{QUERY}') THEN 0.35 ELSE 0 END::DOUBLE + 0.12::DOUBLE
  + CASE WHEN regexp_matches(title, '(?i)(guideline|guidelines|consensus|recommendations?|指南|共识)') THEN 0.08 ELSE 0 END::DOUBLE AS boost, CAST(nullif(regexp_extract(publication_date, '(19\\d{{2}}|20\\d{{2}})', 1), '') AS INT) AS y FROM z)
ORDER BY round(base_score * (1 + boost), 6) DESC, coalesce(y, 0) DESC, doc_id LIMIT 10"""


@query("cover_density_topk", f"""WITH {CHUNKS_SQL}, {_lex_sql("c", "ch", "chunk_id", [("title", "A"), ("chunk_type", "B"), ("content", "C")], [["failure", "heart", "telephone"], ["home", "monitoring"]], "(contains(j, ' heart failure ') AND list_contains(ts, 'telephone')) OR (contains(j, ' home monitoring ') AND NOT list_contains(ts, 'newborns'))")}
SELECT id AS chunk_id, score FROM c ORDER BY score DESC, id LIMIT 50""")
def _(s, d):
    return search.cover_density(_raw(s, d, "title", "chunk_type", "content"), '"heart failure" telephone or "home monitoring" -newborns', [("title", "A"), ("chunk_type", "B"), ("content", "C")], "chunk_id", 50, at="ingested_at")


@query("hashing_vectors")
def _(s, d):
    return spread(table(s, d, "eval_items")).select("item_id", R.vector_literal(R.hashing_encoder("text")).alias("vector"))


def _vectors(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One vector for each id, of the whole text of its last row."""
    x = ingest.latest(df, [id_col], "ingested_at")
    return x.select(id_col, R.hashing_encoder(text).alias("vector"))


@query("missing_view_vectors", r"SELECT count(DISTINCT view_id) AS n, 384 AS dim FROM document_views WHERE view_type != 'title_abstract'")
def _(s, d):
    """Vectors are made of those views alone that have none of the model."""
    x = search.delivered_last(table(s, d, "document_views", "view_id", "view_type", "ingested_at"), "view_id", "ingested_at")
    have = x.filter("view_type = 'title_abstract'").select(F.col("view_id").alias("id"), F.lit("hashing").alias("model"))
    texts = x.select("view_id", F.col("view_type").alias("text"))
    made = models.vectorised(texts, have, "view_id", "text", lambda ts: [R.hash_vector(t) for t in ts], "hashing", 384)
    return made.groupBy("dim").agg(F.count_if(F.size("embedding") == 384).alias("n")).select("n", "dim")


@query("model_rerank")
def _(s, d):
    """Chunks re-ranked by a model: here a stand-in that scores by length."""
    raw = _raw(s, d, *hybrid.CHUNK_FIELDS)
    x = search.payload(search.bm25(raw, QUERY, _text(), "chunk_id", 50, at="ingested_at"), raw, "chunk_id", hybrid.CHUNK_FIELDS, "ingested_at")
    return rerank.reranker("chunks", "model", lambda q, ts: [float(len(t)) for t in ts])(x, QUERY, 20).select("chunk_id", "score", "reranker")


@query("card_vectors")
def _(s, d):
    return _vectors(spread(table(s, d, "document_cards", "doc_id", "card_text", "ingested_at")), "doc_id", "card_text")


@query("view_vectors")
def _(s, d):
    return _vectors(spread(table(s, d, "document_views", "view_id", "text", "ingested_at")), "view_id", "text")


@query("chunk_vectors")
def _(s, d):
    return _vectors(spread(table(s, d, "chunks", "chunk_id", "content", "ingested_at")), "chunk_id", "content")


@query("stored_rows")
def _(s, d):
    return ingest.chunk_rows(_chunks(s, d))


_STORED_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, min(k) AS first_key, max(k) AS last_key FROM (SELECT DISTINCT {k} AS k FROM {f}{'' if t == 'documents' else ' WHERE doc_id IN (SELECT doc_key FROM documents)'})"
    for t, f, k in (("documents", "documents", "doc_key"), ("document_cards", "document_cards", "doc_id"), ("document_views", "document_views", "view_id"), ("sections", "sections", "doc_id || '#' || section_index"), ("chunks", "chunks", "chunk_id"))
)


@query("ingest_twice", _STORED_SQL)
def _(s, d):
    """All tables ingested into an empty folder, and once more, which adds nothing."""
    import uuid

    from tessella.session import shared_folder
    from tessella.sources.store import stored

    folder = f"{shared_folder(s)}/ingest-{uuid.uuid4().hex}"
    docs = spread(table(s, d, "documents")).drop("doc_id").withColumnRenamed("doc_key", "doc_id")
    rows = {
        "documents": ingest.document_rows(docs), "document_cards": ingest.card_rows(table(s, d, "document_cards")), "document_views": ingest.view_rows(table(s, d, "document_views")),
        "sections": ingest.section_rows(table(s, d, "sections")), "chunks": ingest.chunk_rows(spread(table(s, d, "chunks"))),
    }
    for _ in range(2):
        ingest.incremental(rows, folder, s)
    out = None
    for name, k in (("documents", "doc_id"), ("document_cards", "doc_id"), ("document_views", "view_id"), ("sections", "concat_ws('#', doc_id, section_index)"), ("chunks", "chunk_id")):
        one = stored(s, folder, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.min(F.expr(k)).alias("first_key"), F.max(F.expr(k)).alias("last_key"))
        out = one if out is None else out.unionByName(one)
    return out


@query("slugs")
def _(s, d):
    return spread(table(s, d, "documents", "doc_id", "source_institution", "publication_date", "text")).select("doc_id", R.doc_id(F.col("source_institution"), F.col("publication_date"), R.sha256_text("text")).alias("slug"))


# -- whole requests


def _store(s: SparkSession, d: str):
    from tessella.api import Store

    return Store(s, d)


def _retrieve_sql(name: str, kind: str | None, k: int, institution: str = "") -> str:
    """name(chunk_id, score, ...) of a retrieval, with its order in o."""
    where = "WHERE NOT coalesce(is_reference_section, false)" + (f" AND source_institution ILIKE '%{institution}%'" if institution else "")
    kinds = f"SELECT doc_id FROM docs WHERE document_kind = '{kind}'" if kind else "SELECT doc_id FROM docs"
    n = min(4 * k, 50)

    def top(c: str) -> str:
        return f"SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (SELECT id, score FROM {name}_{c} WHERE doc_id IN ({kinds}) ORDER BY score DESC, id LIMIT 50)"

    any_of = " OR ".join
    return f"""{name}_b AS (SELECT * FROM ch {where}), {_lex_sql(name + "_t", name + "_b", "chunk_id", [("title", "A"), ("array_to_string(section_path, ' ')", "B"), ("clinical_department", "B"), ("chunk_type", "B"), (_RETRIEVAL_SQL, "C")], [list(dict.fromkeys(BM25_TERMS))], _ALL_OF, ", doc_id")},
{_dense_sql(name + "_d", name + "_b", "chunk_id", "content", extra=", doc_id")}, {name}_f AS (SELECT id AS chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS base FROM ({top("t")} UNION ALL {top("d")}) GROUP BY id),
{name}_k AS (SELECT *, lower(coalesce(content, '')) AS c, lower(coalesce(title, '')) AS ti, lower(coalesce(array_to_string(section_path, ' > '), '')) AS pa FROM {name}_f JOIN ch USING (chunk_id) ORDER BY base DESC, chunk_id LIMIT {n}),
{name}_n AS (SELECT *, ({' + '.join(f"(CASE WHEN contains(c, '{w}') THEN 1 ELSE 0 END)" for w in BM25_TERMS)}) AS hits FROM {name}_k),
{name}_s AS (SELECT chunk_id, doc_id, section_path, token_count, round(base * (1 + CASE WHEN contains(c, '{QUERY}') THEN 0.36 ELSE 0 END + CASE WHEN hits > 0 THEN least(0.26, 0.08 + hits / 6.0::DOUBLE * 0.22) ELSE 0 END + CASE WHEN {any_of(f"contains(pa, '{w}')" for w in BM25_TERMS)} THEN 0.12 ELSE 0 END
  + CASE WHEN {any_of(f"contains(ti, '{w}')" for w in BM25_TERMS)} THEN 0.08 ELSE 0 END + CASE chunk_type WHEN 'recommendation' THEN 0.18 WHEN 'key_message' THEN 0.14 WHEN 'pico' THEN 0.12 WHEN 'algorithm' THEN 0.10 WHEN 'evidence' THEN 0.06 WHEN 'table' THEN 0.05 ELSE 0 END)
  * greatest(0.05, 1 - least(0.9, CASE WHEN regexp_matches(pa, 'references?|bibliography|参考文献') THEN 0.35 ELSE 0 END)), 6) AS score FROM {name}_n),
{name} AS (SELECT *, row_number() OVER (ORDER BY score DESC, coalesce(token_count, 0) DESC, chunk_id) AS o FROM {name}_s QUALIFY o <= {k})"""


@query("hybrid_search", HYBRID_SQL)
def _(s, d):
    st = _store(s, d)
    return st.search(QUERY, topk=10).select("doc_id", "title", "score", "base_score", "boost")


@query("hybrid_retrieve", f"""WITH {DOCS_SQL}, {CHUNKS_SQL}, {_retrieve_sql("r", None, 10)}, sec AS (SELECT doc_id, section_path, arg_min({{'h': heading, 'a': char_start, 'b': char_end}}, section_index) AS x FROM sections GROUP BY ALL)
SELECT chunk_id, r.doc_id, score, coalesce(x.h, r.section_path[-1]) AS heading, x.a AS char_start, x.b AS char_end FROM r LEFT JOIN sec ON r.doc_id = sec.doc_id AND r.section_path = sec.section_path""")
def _(s, d):
    return _store(s, d).retrieve(QUERY, topk=10).select("chunk_id", "doc_id", "score", "heading", "char_start", "char_end")


@query("retrieve_with_fallback", f"""WITH {DOCS_SQL}, {CHUNKS_SQL}, {_retrieve_sql("g", "guideline", 10, "Council")}, {_retrieve_sql("c", "consensus", 10, "Council")}
SELECT chunk_id, score, false AS is_fallback FROM g UNION ALL SELECT chunk_id, score, true FROM (SELECT *, row_number() OVER (ORDER BY score DESC, chunk_id) AS p FROM c WHERE chunk_id NOT IN (SELECT chunk_id FROM g)) WHERE p <= 10 - (SELECT count(*) FROM g)""")
def _(s, d):
    return _store(s, d).retrieve_with_fallback(QUERY, topk=10, institution="Council").select("chunk_id", "score", "is_fallback")


@query("hybrid_search_routed")
def _(s, d):
    """With kind and department, so that kinds are asked of the documents and quotas route."""
    return _store(s, d).search(QUERY, topk=10, kind="guideline", department="cardiology").select("doc_id", "title", "scope", "score", "base_score")


@query("hybrid_retrieve_routed")
def _(s, d):
    return _store(s, d).retrieve(QUERY, topk=10, kind="guideline", department="cardiology").select("chunk_id", "doc_id", "scope", "score")
