"""Residue, scan noise, wrong encodings and markup: what is found, what isn't, and what comes out."""

from __future__ import annotations

import numpy as np
import pytest

from tessella.llm import chars, encoding, markup, residue, scan
from tessella.llm.counts import Counts

PROSE = [
    "Patients should be told that treatment may affect walking distance during the first weeks.", "Sjögren’s and Ménière’s registries report 3.6 ± 0.5 °C at each visit.", "La réévaluation du traitement est conseillée après la première dose.", "Für ältere Menschen wird frühe Mobilisierung empfohlen, auch während der Behandlung.",
    "与常规治疗相比，戒烟干预可降低步行距离风险，建议患者每日复查。", "Offer oxygen titration to adults when liver enzymes remains abnormal.", "关于弹力袜能否推迟住院时间，目前尚无一致意见，起始剂量和用量另列。", "Costs fell by 40% in the year after early mobilisation was introduced.",
] * 30


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, x, x) for i, x in enumerate(PROSE)] + [(-1, None, None), (-2, "", "")], "doc_id long, text string, content_md string")


@pytest.fixture(scope="module")
def pairs(frame):
    return chars.pair_model(frame, "text")


def test_pair_counts(pairs):
    assert pairs.total == sum(map(len, PROSE)) + len(PROSE) + 1 or pairs.total >= sum(map(len, PROSE))
    assert pairs.log("zq").sum() < pairs.log("th").sum()


@pytest.fixture(scope="module")
def prose(spark, tiny):
    return residue.prose_model(residue.prose_columns(spark.read.parquet(f"{tiny}/documents.parquet")), "text", "headings")


FOUND = ["Lorem ipsum dolor sit amet", "Consensus on ${title}: draft", "Treatment of [topic] in primary care", "Access Denied.", "Please enable JavaScript to view this page", "请启用JavaScript后继续浏览", "HTTP 502: resource unavailable", "XX病诊疗规范（XXXX年版）", "TITLE TBD", "{{abstract | upper}}",
         "Patients should be told that treatment may affect walking distance. Your access has been rate limited."]
CLEAN = [None, "", " ", ".", "JavaScript-free decision aids for people on dialysis", "Access denied: barriers to home monitoring for inpatients", "Guideline on gout [updated]", "用药错误上报专家共识", "Patients should be told that treatment may affect walking distance during the first weeks.", "Dosing sets {3, 5, 7} mg of treatment in adults"]


def test_residue(spark, prose):
    d = spark.createDataFrame([(i, x, "x") for i, x in enumerate(FOUND + CLEAN)], "doc_id long, title string, found string")
    got = {r.doc_id: r for r in residue.residue_column(d, "doc_id", ("title",), prose).collect()}
    assert [got[i].found for i in range(len(FOUND + CLEAN))] == [True] * len(FOUND) + [False] * len(CLEAN)
    assert got[len(FOUND) - 1].kept == "Patients should be told that treatment may affect walking distance."
    assert got[len(FOUND)].kept is None and got[0].kept == ""
    assert residue.residue_column(d.limit(0), "doc_id", ("title",), prose).count() == 0


@pytest.mark.parametrize("how", [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("utf-8", "cp437"), ("gb18030", "latin-1"), ("cp1252", "cp850")])
def test_garbled_text_is_restored(pairs, how):
    to, wrong = how
    text = PROSE[4] if to == "gb18030" else PROSE[3] if to == "cp1252" else PROSE[2]
    try:
        bad = text.encode(to).decode(wrong)
    except UnicodeDecodeError:
        bad = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in text.encode(to))
    chain, ratio, back = encoding.evidence(bad, pairs)[0]
    assert back == text and ratio > 5


def test_twice_garbled(pairs):
    once = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in PROSE[2].encode())
    twice = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in once.encode())
    assert encoding.evidence(twice, pairs)[0][2] == PROSE[2]


@pytest.mark.parametrize("text", [PROSE[1], PROSE[4], "SÃO BRUMÓ AÇÃO registry: Ångström-level imaging, ½ dose arms.", "ÄRZTLICHE ÜBERPRÜFUNG: GRÖßE UND GEWICHT", "pdf_text_mojibake", "第11页 共88页", ""])
def test_real_characters_stay(pairs, text):
    e = encoding.evidence(text, pairs)
    assert not e or e[0][1] < 6


def test_weak_evidence_is_pooled(spark):
    weak = encoding.signature([("utf-8 as windows", 4.2, "")], False)

    def lines(n):
        return spark.createDataFrame([("document", f"k{i}", "s", 0, weak) for i in range(n)], "item_kind string, item_key string, source string, line int, signature string")

    sizes = spark.createDataFrame([("s", "document", 200)], "source string, item_kind string, records long")
    alone, many = (encoding.posteriors(lines(n), sizes).first().posterior for n in (1, 60))
    assert alone < 0.5 < many
    assert encoding.posteriors(lines(0), sizes).count() == 0


def test_clear_lines_decide_between_chains():
    """A line that two chains restore alike goes to the chain that the source's other lines show."""
    both = encoding.signature([("utf-8 as cp437", 6, ""), ("utf-8 as cp850", 6, "")], False)
    for clear in ("utf-8 as cp437", "utf-8 as cp850"):
        post, chain = encoding.maximized([both, encoding.signature([(clear, 20, "")], False), encoding.signature([], True)], np.array([3.0, 40.0, 1.0]), 100.0)
        assert post.min() > 0.5 and [encoding.names()[k] for k in chain] == [clear, clear, encoding.LOST]


def test_lost_and_mixed_lines(pairs):
    got = encoding.suspicious_lines(["fine\nr�p�ter\n", "ascii", ""], pairs)
    assert [n for n, _ in got[0]] == [1] and 1 not in got
    assert encoding.restore("a\nÃ©t\nb", {1: "utf-8 as windows", 7: "utf-8 as windows"}) == "a\nét\nb"


MARKED = {
    "a <b>b</b> c": ("html", "a b c"), "x &gt; y &amp; z": ("html", "x > y & z"), "<h3>Dose</h3>\n<ul>\n<li>one</li>\n<li>two</li>\n</ul>": ("html", "### Dose\n\n- one\n- two"), "H<sub>2</sub>O": ("html", "H₂O"), "<!-- imported block 3 -->\ntext": ("html", "text"),
    "<TABLE BORDER=1><TR><TD>a<TD>1</TR></TABLE>": ("html", "| a | 1 |\n|---|---|"), "<pre><code>if a &gt; b:\n    c</code></pre>": ("html", "```\nif a > b:\n    c\n```"), "[[report|report]] it": ("wiki", "report it"), "'''Start''' at": ("wiki", "Start at"), "== Dose ==\nx": ("wiki", "## Dose\nx"),
    '{| class="wikitable"\n! a !! n\n|-\n| b || 3\n|}\n': ("wiki", "| a | n |\n|---|---|\n| b | 3 |"), "\\textbf{bold} and (\\SI{54}{\\milli\\gram})": ("latex", "bold and (54 mg)"), "\\begin{itemize}\n\\item one\n\\end{itemize}": ("latex", "- one"), "\\[ \\Delta \\ge 2 \\]": ("latex", "$\\Delta \\ge 2$"), "\\subsection{Dose}\\label{sec:1}\nx~\\cite{r}": ("latex", "### Dose\nx"),
    "&lt;p&gt;both&lt;/p&gt;": ("html", "both"), "<script>var t=1;</script>text": ("html", "text"),
}
PLAIN = [None, "", "# A\n\n- b\n\n| c | d |\n|---|---|\n| 1 | 2 |", "Results <LOD were set to LOD/2; P<0.05 and t>2", "R&D and M&M cost $33 to $791", "see C:\\scans\\batch_33", "ranges 5~23 and 3' 20'' occurred", "[1, 5] and {1, 7}", "<!-- page: 3 -->", "```\n<b>x</b>\n```", "`<b>` is code", "a_1 and a_2 & controls; cost < $ 73"]


@pytest.mark.parametrize("text", MARKED)
def test_markup(text):
    kind, want = MARKED[text]
    assert kind in markup.kinds(text) and markup.clean(text).strip() == want


@pytest.mark.parametrize("text", PLAIN)
def test_no_markup(text):
    assert not markup.kinds(text) and markup.clean(text) == text


def test_only_content_of_a_page():
    page = "\n".join(f'<li><a href="/{i}">m</a></li>' for i in range(120)) + "\n" + "\n".join("<p>" + "A long sentence of real content stands here. " * 4 + "</p>" for _ in range(12))
    out = markup.clean(page)
    assert out.count("real content") == 48 and out.count("- m") < 10


_SENTENCE = "A long sentence of real content stands here. " * 4


def test_links_go_from_a_short_page():
    out = markup.clean("\n".join(f'<div><a href="/{i}">m{i}</a></div>' for i in range(12)) + f"\n<p>{_SENTENCE}</p>\n<p>{_SENTENCE}</p>\n<p>Give 5 mg.</p>")
    assert out.count("real content") == 8 and "Give 5 mg." in out and "m0" not in out and "m6" not in out


@pytest.mark.parametrize("n", [3, 300])
def test_no_size_drops_structure(n):
    rows = "\n".join(f'<tr><td>r{i}x</td><td><a href="/{i}">{i}</a></td></tr>' for i in range(n))
    items = "\n".join(f'<li><a href="/{i}">i{i}x</a></li>' for i in range(n))
    out = markup.clean(f"<p>{_SENTENCE}</p>\n" * 5 + f"<h2><a>Dose</a></h2>\n<table>\n{rows}\n</table>\n<ul>\n{items}\n</ul>\n<pre>\nk = 1\n</pre>\n<p><a>$x^{{2}}$</a></p>\n<p>Short.</p>\n" + f"<p>{_SENTENCE}</p>\n" * 5)
    assert all(f"| r{i}x | {i} |" in out and f"- i{i}x" in out for i in range(n))
    assert "## Dose" in out and "k = 1" in out and "$x^{2}$" in out and "Short." in out and out.count("real content") == 40


def test_markup_column(spark):
    d = spark.createDataFrame([("a", None, 1), ("b", "<b>x", 1), ("b", "<b>x", 1), ("c", "y" * 500_000, 1)], "k string, content string, cleaned int")
    assert sorted((r.k, r.cleaned) for r in markup.clean_column(d, "content", "k", only_marked=True).collect()) == [("b", "x"), ("b", "x")]


@pytest.fixture(scope="module")
def repair(frame, pairs):
    return scan.Repair(scan.word_model(frame, "text"), pairs)


NOISY = {
    "Patients should be told that\ntreatment may affect walking distance during the first weeks.": PROSE[0], "Patients should be told that treat-\n  ment may affect walking distance during the first weeks.": PROSE[0], "Patients shou|d be to1d that trcatment may aff^ect walking distance during the first weeks.": PROSE[0],
    "Patients should be told that\n\nPage 3\n\ntreatment may affect walking distance during the first weeks.": PROSE[0], "Patients s h o u l d be told that treatment may affect walking distance during the first weeks.": PROSE[0], "与常规冶疗相比，戒烟干预可降低步行距离风险ꎬ建议惠者每曰复查ꎮ": PROSE[4], "与常规治疗相比，戒烟 干预可降低步\n行距离风险，建议患者每日复查。": PROSE[4],
    PROSE[7] + "\n\nNorth Council 2019   7\n\n" + PROSE[5]: PROSE[7] + "\n\n" + PROSE[5],
}


@pytest.mark.parametrize("text", NOISY)
def test_scan_noise(repair, text):
    got, edits = repair.repair(text, ["North Council", None])
    assert got == NOISY[text] and edits


@pytest.mark.parametrize("text", [None, "", " ", *PROSE[:8], "# A\n\n- one\n- two\n\n| a | b |\n|---|---|\n| 1 | 2 |", "Score: 12\n\nsee page 3.", "```\na = 1\nb\n```", "six-week and on-call", PROSE[0] + "\r\n\r\n" + PROSE[1]])
def test_no_scan_noise(repair, text):
    got, edits = repair.repair(text, [])
    assert got == text and not edits


@pytest.mark.parametrize("size", [1, 3, 50, 5000])
def test_scan_errors_at_any_size(pairs, size):
    counts = {"after": 23_661, "aftcr": 46, "every": 8_519, "evcry": 15, "house": 9_000, "honse": 900, "thoughtfulness": 1}
    r = scan.Repair(scan.WordModel({w: float(n * size) for w, n in counts.items()}, Counts(np.zeros(0, np.uint64), np.zeros(0)), sum(counts.values()) * size), pairs)
    assert r.repair("Aftcr treatment, evcry honse with t h o u g h t f u l n e s s here.")[0] == "After treatment, every honse with thoughtfulness here."


def test_readings_equal_brute_force(pairs):
    """All words of a lexicon that any number of confusions turns into the token, found by undoing every one of them."""
    lexicon = dict.fromkeys(["house", "honest", "kill", "hill", "lid", "modern", "little", "told", "title", "minimum", "him", "dam", "clam"], 1000.0)
    m = scan.WordModel(lexicon, Counts(np.zeros(0, np.uint64), np.zeros(0)), 13_000.0)

    def misread(x):
        """All ways to misread a word, each character once."""
        if not x:
            yield ""
        for bad, goods in scan.CONFUSIONS.items():
            for good in filter(x.startswith, filter(None, goods)):
                yield from (bad + rest for rest in misread(x[len(good) :]))
        if x:
            yield from (x[0] + rest for rest in misread(x[1:]))

    for word in lexicon:
        for token in set(misread(word)) - set(lexicon):
            if len(token) >= 3 and any(c.isalpha() for c in token):
                assert word in m.readings(token, 1.0), (word, token)
    assert m.readings("rnininnurn" * 40, 1.0) == {} and "title" in m.readings("tit|e", 1.0)


def test_confusions_are_estimated(spark):
    d = spark.createDataFrame([(" ".join(["the patient should rest here before the treatment"] * 400 + ["thc patient should rest", "here bcforc the treatmcnt", "the paticnt should rest herc"]),)] * 40, "text string")
    m = scan.word_model(d, "text")
    assert m.share("c", "e") > m.share("|", "l") and m.count("patient") == 16_040 and m.pair("the", "patient") == 16_000
    assert scan.Repair(m, None).repair("Give thc paticnt rest.", [])[0] == "Give the patient rest."


def test_scan_column(spark, frame, pairs):
    d = spark.createDataFrame([("a", None, "t", 1), ("b", "Page 3", None, 1), ("b", "Page 3", None, 1), ("c", "clean text " * 9000, "t", 1)], "k string, content string, title string, edits int")
    got = scan.repair_column(d, "content", ("k",), ("title",), scan.word_model(frame, "text"), pairs, only_noisy=True).collect()
    assert sorted((r.k, r.repaired, r.edits["furniture"]) for r in got) == [("b", "", 1), ("b", "", 1)]
    assert np.isfinite(pairs.log("\U0001f600é")).all()


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p7_ids", "p8_found", "p9_found"])
def test_queries_have_their_columns(spark, tiny, name):
    from tessella.llm.queries import QUERIES

    want = {"p2_found": ["doc_id", "field_name"], "p5_found": ["query_id", "chunk_id"], "p7_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id_a", "doc_id_b"]}
    df = QUERIES[name](spark, tiny)
    assert df.columns == want.get(name, ["item_kind", "item_key"])
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert rows and len(rows) == len(set(rows))


def test_residue_of_unseen_phrases(prose):
    """Fitted on half of the phrases: recall on the other half, and precision on prose."""
    from tessella.llm import seeds

    halves = [seeds.halves(x) for x in (seeds.filler(), seeds.notices())]
    model = residue.Residue(prose, halves[0][0], halves[1][0])
    for _, rest in halves:
        got = model.residue([x.replace("<n>", "47") for x in rest])
        assert sum(map(bool, got)) >= 0.97 * len(rest)
    assert not any(model.residue(PROSE[:8]))
