from __future__ import annotations

import math
from collections import Counter

import numpy as np

import pytest
from pyspark.sql import functions as F

from tessella.operators import aggregates, chunking, classify, cleaning, filters, fusion, joins, markdown, metadata, rerank, search, structural, views
from tessella.sources import files, ingest, models, store


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_filters(spark):
    d = spark.createDataFrame([("a", "North Council", "unknown", "guideline"), ("b", "Council", "2020-01-01", "consensus"), ("c", None, None, None)], "id string, source_institution string, publication_date string, document_kind string")
    assert [r.id for r in filters.search_filter(d, institution="council").collect()] == ["a", "b"]
    assert [r.id for r in filters.search_filter(d, time_range="2019").collect()] == ["a", "b"]  # letters follow digits
    assert [r.id for r in filters.search_filter(d, time_range="2019-2021").collect()] == ["b"]
    assert filters.search_filter(d).count() == 3
    with pytest.raises(ValueError):
        filters.read_document(d)


def brute_bm25(docs, query):
    toks = {i: t.lower().split() for i, t in docs}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = Counter(w for t in toks.values() for w in set(t))
    out = []
    for i, t in toks.items():
        s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * max(1, len(t)) / max(1, avg))) for w in query.split() if w in t)
        if s > 0:
            out.append((i, round(s, 6)))
    return sorted(out, key=lambda x: (-x[1], x[0]))


def test_bm25_counts_repeated_terms(spark):
    docs = [("a", "heart failure heart"), ("b", "failure of kidneys and of liver"), ("c", ""), ("d", "nothing")]
    d = spark.createDataFrame(docs, "id string, t string")
    for q in ("heart", "heart heart failure", "of failure", "absent"):
        assert [(r.id, r.score) for r in search.bm25(d, q, "t", "id").collect()] == brute_bm25(docs, q)
    assert search.bm25(d, "", "t", "id").count() == 0


def test_full_text(spark):
    d = spark.createDataFrame([(1, "heart failure", "x"), (2, "failure", "heart of stone"), (3, "heart", "failure failure"), (4, "kidney", "heart failure children")], "id int, a string, b string")
    hits = [r.id for r in search.cover_density(d, '"heart failure" or kidney -children', [("a", "A"), ("b", "C")], "id").collect()]
    assert 1 in hits and 2 not in hits and 4 in hits  # the excluded word belongs to its own alternative
    best = search.cover_density(d, "heart failure", [("a", "A"), ("b", "C")], "id").collect()
    assert best[0].id == 1 and {r.id for r in best} == {1, 2, 3, 4}


def test_dense(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0])], "id int, v array<double>")
    assert rows(search.dense_topk(d, [1.0, 0.0], "v", "id", 2)) == [(1, 1.0), (2, 0.707107)]
    with pytest.raises(Exception, match="not usable"):
        search.check_dimension(d, "v", 2).collect()


def test_rrf_is_blind_to_the_order_of_channels(spark):
    a = spark.createDataFrame([("A", "x", 1), ("B", "x", 2), ("A", "y", 2), ("C", "y", 1)], "id string, channel string, rank int")
    got = {r.id: r.score for r in fusion.rrf(a).collect()}
    assert got == {"A": round(1 / 61 + 1 / 62, 9), "B": round(1 / 62, 9), "C": round(1 / 61, 9)}
    assert {r.id for r in fusion.rrf(a, weights={"x": 1.0, "y": 0.0}).collect()} == {"A", "B"}
    assert fusion.rrf(a, weights={"x": -1.0}).count() == 0


def test_quota_fills_up(spark):
    d = spark.createDataFrame([(i, "single" if i % 3 else "compositive", 100.0 - i) for i in range(30)], "id int, scope string, score double")
    got = fusion.quota(d, "scope", [F.desc("score"), F.col("id")], {"single": 8, "compositive": 1}, 10).collect()
    assert len(got) == 10 and sum(r.scope == "compositive" for r in got) == 2  # one by quota, one by filling up
    assert [r.id for r in got] == sorted(r.id for r in got)


def test_fallback(spark):
    a = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "id string, score double")
    b = spark.createDataFrame([("b", 9.0), ("c", 3.0), ("d", 2.0)], "id string, score double")
    got = fusion.fallback(a, b, [F.desc("score"), F.col("id")], 3, "id").collect()
    assert [(r.id, r.is_fallback) for r in got] == [("a", False), ("b", False), ("c", True)]


def test_minmax_of_equal_scores(spark):
    d = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id int, s double")
    assert fusion.minmax(d, "s", "n").first().n == pytest.approx(1 / (1 + math.exp(-2)))
    assert fusion.minmax(d, "s", "n", equal="one").first().n == 1.0


def test_unique_documents_and_last_payload(spark):
    d = spark.createDataFrame([("d1", 3.0, "x"), ("d1", 2.0, "y"), ("d2", 1.0, "z")], "doc_id string, score double, id string")
    assert [(r.doc_id, r.score) for r in fusion.unique_documents(d, 2).collect()] == [("d1", 3.0), ("d2", 1.0)]
    a, b = (spark.createDataFrame([("d1", v)], "doc_id string, v string") for v in ("first", "last"))
    assert fusion.last_payload([a, b], "doc_id").first().v == "last"


def test_context(spark):
    s = spark.createDataFrame([("d", 1, ["A", "B"], "late", 5, 9), ("d", 0, ["A", "B"], "B!", 1, 4)], "doc_id string, section_index int, section_path array<string>, heading string, char_start int, char_end int")
    i = spark.createDataFrame([("d", ["A", "B"]), ("d", ["A"]), ("e", None)], "doc_id string, section_path array<string>")
    got = {(r.doc_id, tuple(r.section_path or ())): (r.heading, r.char_span_kind) for r in joins.section_context(i, s).collect()}
    assert got == {("d", ("A", "B")): ("B!", "section"), ("d", ("A",)): ("A", None), ("e", ()): (None, None)}


CHUNK = "chunk_id string, title string, source_institution string, clinical_department string, publication_date string, section_path array<string>, chunk_type string, content string, is_reference_section boolean, token_count int, score double"


def test_rerank_by_model(spark):
    d = spark.createDataFrame([(i, "t", "s", "d", "2020", ["A"], "other", x, False, 1, 0.5) for i, x in (("a", "xx"), ("b", "x"))], CHUNK)
    by = rerank.reranker("chunks", "model", lambda q, ts: [0.9 if t.endswith("Content: x") else 0.1 for t in ts])
    assert [(r.chunk_id, r.reranker) for r in by(d, "q", 2).collect()] == [("b", "model"), ("a", "model")]

    def down(q, ts):
        raise OSError("no service")

    got = rerank.reranker("chunks", "model", down)(d, "xx", 2).collect()
    assert [r.chunk_id for r in got] == ["a", "b"] and "failed" in got[0].reranker and got[0].model_error == "no service"
    assert [r.chunk_id for r in rerank.reranker("chunks", "none")(d, "x", 1).collect()] == ["a"]
    with pytest.raises(ValueError):
        rerank.reranker("documents", "model")
    docs = spark.createDataFrame([("a", "Guideline on x", "2020", 0.5, 4, "", "", ""), ("b", "y", "2021", 0.4, 4, "", "", "")], "doc_id string, title string, publication_date string, score double, channels int, card_text string, view_text string, chunk_text string")
    assert [r.doc_id for r in rerank.reranker("documents", scorer=lambda q, ts: [float("Title: y" in t) for t in ts])(docs, "x", 2).collect()] == ["b", "a"]


def test_service_answers():
    assert models.in_order([{"index": 1, "v": 2}, {"index": 0, "v": 1}], 2, "v") == [1, 2] and models.unit([3, 4], 2) == [0.6, 0.8]
    for bad in ([{"index": 0, "v": 1}], [{"index": 0, "v": 1}, {"index": 5, "v": 1}], None):
        with pytest.raises(ValueError):
            models.in_order(bad, 2, "v")
    for bad in ([0, 0], [float("nan"), 1], [1]):
        with pytest.raises(ValueError):
            models.unit(bad, 2)


def test_service_over_http(spark):
    import http.server
    import json
    import threading

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            x = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            out = {"data": [{"index": i, "embedding": [float(len(t)), 1.0]} for i, t in reversed(list(enumerate(x["input"])))]} if "input" in x else {"results": [{"index": i, "relevance_score": len(t)} for i, t in enumerate(x["documents"])]}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(out).encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    assert models.service_scorer(url, "m")("q", ["a", "bb"]) == [1.0, 2.0]
    d = spark.createDataFrame([("a", ""), ("b", "xyz"), ("c", None)], "id string, t string")
    have = spark.createDataFrame([("c", "m")], "id string, model string")
    got = models.vectorised(d, have, "id", "t", models.service_encoder(url, "m", 2), "m", 2).collect()
    assert {r.id: r.embedding for r in got} == {"a": [0.0, 1.0], "b": [3 / 10**0.5, 1 / 10**0.5]}
    server.shutdown()
    server.server_close()
    with pytest.raises(OSError):
        models.post_json(url, {}, timeout=1, attempts=2, wait=0.01)
    empty = models.channel(lambda: spark.createDataFrame([(models.service_scorer(url, "m", timeout=1, attempts=1)("q", ["a"])[0],)]), d)
    assert empty.isEmpty() and empty.columns == d.columns


def test_structural_chunks(spark):
    md = "# G\n\n## Care\nWe recommend rest. Give 5 mg daily.\n\nTrials showed benefit in adults.\n\n12\n\n# References\nWe recommend nothing here."
    d = spark.createDataFrame([("d", md, "T"), ("e", "", "only"), ("f", None, None), ("g", "# H\n<b>", None)], "k string, md string, title string")
    got = structural.structural_chunks(d, "md", "title", "k").orderBy("k", "chunk_type").collect()
    assert [(r.k, r.chunk_type, r.text) for r in got] == [("d", "clinical_detail", "Give 5 mg daily."), ("d", "general", "Trials showed benefit in adults."), ("d", "recommendation_bundle", "We recommend rest.\n\nEvidence:\nTrials showed benefit in adults."), ("e", "general", "only"), ("f", "general", "f"), ("g", "general", "<b>")]
    assert len({r.chunk_id for r in got}) == len(got)
    long = [f"Sentence number {i} has some more words in it." for i in range(120)]
    groups = structural.bundles("We recommend x.", [" ".join(long)])
    assert len(groups) > 1 and [x for g in groups for x in g] == long and all(len(structural.bundle("We recommend x.", g)) <= structural.BUNDLE for g in groups)
    assert structural.in_references(["1. References"]) and structural.in_references(["Funding"]) and not structural.in_references(["Preferences"])
    found = structural.search(structural.structural_chunks(d, "md", "title", "k"), "rest", 2, scorer=lambda q, ts: [float("benefit" in t) for t in ts]).collect()
    assert found[0].chunk_type == "recommendation_bundle" and structural.variants("pneumonia below 40")[1] == "低于40%"


def test_quality_penalty_is_capped(spark):
    d = spark.createDataFrame([("poor", "poor", "yes", "failed", "noisy_ocr_title;low_text_signal", "no"), (None,) * 6], "cleaning_quality string, pdf_text_quality string, pdf_needs_ocr string, ocr_status string, cleaning_flags string, source_pdf_needs_ocr string")
    assert [r.m for r in d.select(rerank.quality_multiplier().alias("m")).collect()] == [0.45, 1.0]


MD = "intro\n\n# A\ntext\n\n### C\nmore\n\n## B\n| x | y |\n|---|---|\n| 1 | 2 | 3 |\n| 4 |\n\nNotes: n\n\n# References\n1. r\n"


def test_sections_cover_the_text():
    rows_, got = markdown.find_sections({"text": [MD, None, "no heading\n\n# R\n<!-- reference_section: true -->"]})
    first = [i for i, r in enumerate(rows_) if r == 0]
    assert [got["section_path"][i] for i in first] == [["Preface"], ["A"], ["A", "C"], ["A", "B"], ["References"]]
    assert "".join(MD[got["char_start"][i] : got["char_end"][i]] for i in first) == MD
    assert [got["is_reference_section"][i] for i in first] == [False] * 4 + [True]
    assert got["heading"][5:] == ["Document", "Preface", "R"] and got["section_index"][5:] == [0, 0, 1] and got["is_reference_section"][7]


def test_blocks_and_tables(spark):
    d = spark.createDataFrame([(1, MD), (2, None), (3, "<!-- page: 4 -->\nshort"), (4, "\r\n## X\r\npage 7\r\n#### Y\r\n| a |\r\n| 1 |\r\nend")], "id int, md string")
    b = markdown.parse_blocks(d, "md", "id")
    got = b.filter("id = 1").orderBy("order_index").collect()
    assert [r.kind for r in got] == ["text", "heading", "text", "heading", "text", "heading", "table", "text", "heading", "text"]
    assert [r.order_index for r in got] == list(range(10)) and got[4].heading_path == ["A", "C"] and got[6].heading_path == ["A", "B"] and got[0].heading_path == []
    assert all(r.text in MD[r.char_start : r.char_end] for r in got) and got[6].note == "Notes: n"
    assert b.filter("id = 3").first().page == 4 and b.filter("id = 3").first().block_type == "title"
    last = b.filter("id = 4").orderBy("order_index").collect()
    assert [(r.kind, r.text, r.page, r.heading_path) for r in last] == [("heading", "X", None, ["X"]), ("heading", "Y", 7, ["X", "Y"]), ("table", "| a |\r\n| 1 |", 7, ["X", "Y"]), ("text", "end", 7, ["X", "Y"])]
    t = markdown.table_chunks(b, "id").orderBy("id", "row_index").collect()
    assert [(r.cells, r.note, r.warning) for r in t] == [(["1", "2"], "Notes: n", None), (["4", ""], "Notes: n", None), (None, None, "table_header_not_parsed")]


def test_semantic_parts_lose_nothing():
    text = "\n\n".join(f"Sentence {i} about dosing and monitoring of patients." for i in range(200)) + "\n\n" + "word " * 900
    got = chunking.semantic_parts(text)
    assert max(n for *_, n in got) <= chunking.MOST
    want = Counter(chunking._TOKEN.findall(text))
    assert not want - Counter(t for x, *_ in got for t in chunking._TOKEN.findall(x))
    assert chunking.semantic_parts(None) == [] == chunking.semantic_parts("# only a heading\n")
    assert [t for _, t, _ in chunking.semantic_parts("We recommend rest.\n\n| a |\n| b |")] == ["recommendation", "table"]
    assert chunking.recommendations("1.1 We suggest a\n1.2 Avoid b") == ["1.1 We suggest a", "1.2 Avoid b"]
    assert chunking.recommendations("- Offer a\n- Consider b") == ["- Offer a", "- Consider b"] and chunking.recommendations(" one\n") == ["one"]


def test_budgets_against_a_loop():
    import random

    r = random.Random(3)
    for _ in range(200):
        n = [r.randint(1, 60) for _ in range(r.randint(0, 30))]
        want, now, total = [], 0, 0
        for i, x in enumerate(n):
            if i > now and (total + x > 100 or total >= 70):
                want.append((now, i))
                now, total = i, 0
            total += x
        if n:
            want.append((now, len(n)))
        assert chunking.budgets(np.array(n, int), 70, 100) == want
    assert [len(x.split()) for x in chunking.window_pieces("w " * 1000, 420, 40)] == [420, 420, 240] and chunking.window_pieces("", 4, 1) == []


def test_atomic_and_parent_chunks(spark):
    long = "word " * 1000
    d = spark.createDataFrame([(1, "T", f"{long}\n\n# A\n1.1 We recommend x\n1.2 We suggest y\n\n# B\nplain"), (2, None, ""), (3, "only", "# H\n***")], "id int, title string, md string")
    b = markdown.parse_blocks(d, "md", "id")
    atoms = chunking.atomic_chunks(b, "id")
    got = atoms.filter("id = 1").orderBy("order_index", "part_index").collect()
    assert [(r.order_index, r.part_index, r.token_count) for r in got] == [(0, 0, 900), (0, 1, 180), (2, 0, 5), (2, 1, 5), (4, 0, 1)]
    assert got[2].content == "1.1 We recommend x" and "heading_missing" in got[0].warnings and "chunk_too_short" in got[2].warnings and len({r.chunk_id for r in got}) == 5
    parents = chunking.section_chunks(d, "md", "title", "id")
    assert [(r.id, r.heading_path, r.order_start, r.order_end) for r in parents.orderBy("id", "order_start").collect()] == [(1, ["T"], 0, 0), (1, ["A"], 1, 2), (1, ["B"], 3, 4), (3, ["H"], 0, 1)]
    assert chunking.parent_of(atoms, parents, "id").filter("parent_section_id IS NULL").isEmpty()
    docs = chunking.chunk_documents(d, "md", "title", "id").filter("chunk_type = 'summary'").collect()
    assert [(r.id, r.content) for r in docs] == [(3, "only H")]


def test_types(spark):
    d = spark.createDataFrame([("References", ["References"], "x"), ("", ["临床问题"], ""), ("Drugs", [], "We recommend it"), (None, None, None)], "h string, p array<string>, c string")
    assert [r[0] for r in d.select(classify.section_type(F.col("h"), F.col("p"), F.col("c"))).collect()] == ["reference", "pico", "recommendation", "other"]


def test_labels(spark):
    d = spark.createDataFrame([(1, "Asthma and heart failure", "asthma"), (2, "x", "asthmatic")], "id int, t string, b string")
    rules = [("lung", "asthma", 4, 1), ("heart", "heart failure", 4, 1), ("liver", "liver", 4, 1)]
    s = classify.keyword_scores(d, "id", F.col("t"), F.col("b"), rules)
    assert sorted(rows(s.select("id", "label", "score"))) == [(1, "heart", 4.0), (1, "lung", 5.0)]
    assert rows(classify.labels(s, "id")) == [(1, ["lung", "heart"])]


def test_cleaning(spark):
    body = "A long word hyphen-\nated mail me@x.org doi: 10.1000/xyz\n<!-- page: 2 -->\n心房震\n颤动过速。\nA B C D E\nScores were 1 2 3 4 5\n# 12\n*** --- *** ---\n# References\nref 通信作者：某人，某院"
    assert "hyphenated" in cleaning.clean_body(body) and "page" not in cleaning.clean_body(body) and "心房震颤动过速。" in cleaning.clean_body(body) and "ABCDE" in cleaning.clean_body(body) and "@" not in cleaning.clean_body(body)
    got = cleaning.clean_body(body)
    assert "Scores were 1 2 3 4 5" in got and "# 12" not in got and "***" not in got and "# References\n<!-- reference_section: true -->" in got and "某院" not in got
    paged = "<!-- page: 1 -->".join(f"HEAD\n\nbody {i} text\n\nfoot {i}\n" for i in range(4)).replace("<!--", "\n<!--").replace("-->", "-->\n")
    assert "HEAD" not in cleaning.clean_body(paged) and "body 3 text" in cleaning.clean_body(paged)
    assert cleaning.clean_body(None) is None and cleaning.clean_body("") == ""
    a = spark.createDataFrame([("x" * 400,), ("short me@x.org",), (None,)], "b string")
    a = cleaning.assess(a, "b").collect()
    assert [r.quality for r in a] == ["ok", "warning", "poor"] and a[1].flags == ["very_short_text", "email_residue"]
    pages = spark.createDataFrame([(1, "<!-- page: 1 -->".join(f"HEAD\n\nbody {i} text\n\nfoot {i}" for i in range(4))), (2, "HEAD\nHEAD")], "id int, b string")
    assert rows(cleaning.repeated_lines(pages, "id", "b")) == [(1, "HEAD", 4)]


def test_titles_and_sources(spark):
    d = spark.createDataFrame([("中华医学杂志 第 30 卷 第 5 期\n# Guideline on gout care\ntext", "x/y/gout_care.pdf"), (None, "a/Care-of-gout_2020.pdf"), ("", None), ("<!-- page: 1 -->\n** 12 **", "")], "body string, path string")
    assert [r[0] for r in d.select(metadata.find_title(F.col("body"), F.col("path"))).collect()] == ["Guideline on gout care", "Care of gout 2020", "", "12"]
    s = spark.createDataFrame([("C:\\data\\acme_pdf\\1.pdf", "", ""), ("consensus/1.pdf", "of the Council", ""), ("1.pdf", "of the Council", ""), ("1.pdf", "", "x abstract council"), ("hint/1.pdf", None, None), (None, None, None)], "p string, t string, x string")
    by = metadata.source_institution(F.col("p"), F.col("t"), F.col("x"), hints={"hint": "H"}, patterns=[("C", ["council"])])
    assert [r[0] for r in s.select(by).collect()] == ["acme", "Unknown", "C", "Unknown", "H", "Unknown"]
    new = d.withColumn("path", F.lit("z"))
    assert metadata.changes(d.filter("body = ''"), new, "body", ["path"]).collect()[0][1:] == ("path", None, "z")


def test_relabel(spark):
    d = spark.createDataFrame([(["A"], ["A", "B"]), (["未分类"], ["B"]), (["C"], ["A", "B"]), ([], ["A"]), (["C"], [])], "own array<string>, parent array<string>")
    found = F.array(F.lit("B"), F.lit("C"))
    assert [r[0] for r in d.select(metadata.relabelled(F.col("own"), F.col("parent"), found)).collect()] == [["A"], ["B"], ["B"], ["A"], ["未分类"]]
    t = spark.createDataFrame([("Asthma in adults",), ("Table 3",), (None,), ("Other",)], "t string")
    assert [r.l.reason for r in t.select(metadata.title_labels(F.col("t"), [("lung", "asthma")]).alias("l")).collect()] == ["title_rule", "artifact_or_generic_title", "artifact_or_generic_title", "no_precise_signal"]


def test_cards_and_views(spark):
    d = spark.createDataFrame([("k", "T", None, "# T\n\nWe recommend early mobilisation for adults.\nThe target population is adults with gout.\n| a | b |")], "doc_id string, title string, abstract string, content_md string")
    v = {r.view_type: r.text for r in views.views(views.cards(d)).collect()}
    assert set(v) == {"title_abstract", "recommendation_summary", "scope_population", "heading_tree"} and v["heading_tree"] == "T"
    assert len(views.contract(d, views.CARD_FIELDS).columns) == 7


def test_links(spark):
    d = spark.createDataFrame([("d", f"c{i}", i, "A" if i < 7 else "B") for i in range(9)], "doc string, id string, i int, p string")
    n = {r.id: (r.prev_id, r.next_id) for r in chunking.neighbours(d, "doc", "i", "id").collect()}
    assert n["c0"] == (None, "c1") and n["c8"] == ("c7", None)
    links = rows(chunking.same_section_links(d, ["doc", "p"], "i", "id"))
    assert ("c0", "c5") in links and ("c0", "c6") not in links and ("c6", "c7") not in links and len(links) == 5 + 5 + 4 + 3 + 2 + 1 + 1
    assert [r.island for r in chunking.islands(d, "doc", "i", "p").orderBy("i").collect()] == [1] * 7 + [2] * 2


def test_metrics(spark):
    res = spark.createDataFrame([("q1", "a", "d", "table", 1), ("q1", "b", "d", "other", 2)], "query_id string, id string, doc_id string, chunk_type string, rank int")
    rel = spark.createDataFrame([("q1", "b", "d")], "query_id string, id string, doc_id string")
    q = spark.createDataFrame([("q1",), ("q2",)], "query_id string")
    m = aggregates.retrieval_metrics(res, rel, q).first()
    assert (m.recall_5, m.mrr_10, m.doc_recall_10, m.type_precision_10) == (0.5, 0.25, 0.5, 0.25)
    assert aggregates.retrieval_metrics(res, rel, q.limit(0)).first().recall_5 == 0.0


def test_front_matter(spark):
    md = '---\r\nid: "x"\r\ntitle: "a \\"b\\": c"\r\nclinical_departments: ["A", "B"]\r\n---\r\n\r\nbody'
    got = spark.createDataFrame([(md,), ("no header",), ("---\nopen: 1\n",)], "m string").select(files.parse_front_matter(F.col("m")).alias("p")).collect()
    assert got[0].p.header["title"] == 'a "b": c' and got[0].p.body == "body"
    assert got[1].p.header == {} and got[1].p.body == "no header" and got[2].p.body == "---\nopen: 1\n"


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('﻿{"a": 1, "b": "é"}\n\n{"a": 2}\n')
    assert rows(files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a int, b string")) == [(1, "é"), (2, None)]
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="bad JSON line"):
        files.read_jsonl(spark, str(tmp_path / "b.jsonl"), "a int").collect()


def test_ingest(spark, tmp_path):
    folder = str(tmp_path / "t")
    docs = spark.createDataFrame([("existing",)], "doc_id string")
    ch = spark.createDataFrame([("existing", "c1")], "doc_id string, chunk_id string")
    ingest.full_refresh({"documents": docs, "chunks": ch}, folder)
    more = {"documents": spark.createDataFrame([("existing",), ("new",), ("new",)], "doc_id string"), "chunks": spark.createDataFrame([("existing", "c1"), ("new", "c2"), ("new", "c3"), ("new", "c3")], "doc_id string, chunk_id string")}
    assert ingest.incremental(more, folder, spark) == {"skipped_existing_documents": 1, "chunks": 2, "documents": 1}
    again = ingest.incremental(more, folder, spark)
    assert again == {"skipped_existing_documents": 2, "documents": 0, "chunks": 0} and store.stored(spark, folder, "chunks").count() == 3
    with pytest.raises(ValueError):
        ingest.full_refresh({"documents": docs.union(docs)}, str(tmp_path / "u"))
    ingest.replace(store.stored(spark, folder, "chunks").filter("chunk_id != 'c1'"), folder, "chunks")  # of itself
    assert sorted(r.chunk_id for r in store.stored(spark, folder, "chunks").collect()) == ["c2", "c3"]
    assert len(store.vacuum(spark, folder)) == 3 and store.stored(spark, folder, "chunks").count() == 2


def test_a_broken_ingest_can_be_repeated(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    more = {"documents": spark.createDataFrame([("a",), ("b",)], "doc_id string"), "chunks": spark.createDataFrame([("a", "c1"), ("b", "c2")], "doc_id string, chunk_id string")}
    write = ingest.write_part

    def fails(df, folder, name):
        if name == "chunks":
            raise OSError("lost")
        return write(df, folder, name)

    monkeypatch.setattr(ingest, "write_part", fails)
    with pytest.raises(OSError):
        ingest.incremental(more, folder, spark)
    assert store.stored(spark, folder, "documents") is None
    monkeypatch.undo()
    assert ingest.incremental(more, folder, spark) == {"skipped_existing_documents": 0, "documents": 2, "chunks": 2}
    assert ingest.incremental(more, folder, spark)["chunks"] == 0 and store.stored(spark, folder, "documents").count() == 2


def test_stream(spark, tmp_path):
    from tessella.streaming.ingest import append_new, new_rows

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"doc_id": "a", "section_index": 0}\n{"doc_id": "a", "section_index": 0}\n{"doc_id": "a", "section_index": 1}\n')
    for _ in range(2):
        append_new(new_rows(spark, str(tmp_path / "in"), "doc_id string, section_index int"), str(tmp_path / "out"), "sections", str(tmp_path / "cp")).awaitTermination(60)
        (tmp_path / "in" / "2.json").write_text('{"doc_id": "a", "section_index": 1}\n{"doc_id": "c", "section_index": 0}\n')
    assert sorted(map(tuple, store.stored(spark, str(tmp_path / "out"), "sections").collect())) == [("a", 0), ("a", 1), ("c", 0)]


def test_upsert(spark):
    old = spark.createDataFrame([("a", "m", [1.0]), ("b", "m", [1.0])], "id string, model string, embedding array<double>")
    new = spark.createDataFrame([("a", "m", [2.0]), ("a", "n", [3.0])], "id string, model string, embedding array<double>")
    assert sorted(rows(ingest.upsert_vectors(old, new))) == [("a", "m", [2.0]), ("a", "n", [3.0]), ("b", "m", [1.0])]
