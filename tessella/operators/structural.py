"""Structural chunks of guidelines and their index: recommendations with the evidence that follows them, clinical details, and the rest.

Bodies are taken apart in Arrow batches, a document by itself. A text is measured once (Facts), and gates are named conditions on
the measures. What follows a block is a stretch of the arrays of its document, so that nothing is joined. The index is searched by
one scan for all variants of a query: it gives each chunk's numbers, the ranked lists are top-k of those numbers, and texts
are read again for the fused candidates alone.

Defined results: a body without anything to keep gives one general chunk of its first heading, its title or its id.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.batches import expand
from tessella.functions.records import hash_vector, text_similarity
from tessella.functions.text import TOKEN, expand_query, token_overlap, tokens
from tessella.operators import fusion
from tessella.operators.chunking import budgets
from tessella.operators.markdown import find_blocks
from tessella.operators.rerank import Scorer, model_scores
from tessella.operators.search import B, K1, payload, term_frequencies
from tessella.session import cut

#: What recommends, what doses, where sentences end, and what is no content.
ADVICE = r"(?i)\b(recommend(?:s|ing|ations?)?|suggest(?:s|ing|ions?)?|should|is advised|we recommend|we suggest)\b|\b(?:is|are|was|were|be|being)\s+(?:not\s+)?(?:recommended|suggested)\b|\b(?:not\s+)?(?:recommended|suggested)\s+(?:for|to|that|as)\b|(推荐|建议|不推荐|不建议|可推荐|共识建议|专家建议|应当|应该|不应|应在|应根据|应进行|应给予|应避免|应考虑|应首先|应仅限|应采用|应使用|应告知|应评估)"
DOSE = r"\b\d+(?:\.\d+)?\s*(?:[mM][cC][gG]|[mM][gG]|g|[kK][gG]|[mM][lL]|[iI][uU])\b|\b\d+(?:\.\d+)?\s+(?:[uU][nN][iI][tT][sS]?)\b"
DETAIL = rf"({DOSE}|(?i:\b(?:dose|dosage|regimen)\b)|\b(?:IV|PO)\b|剂量|用量|给药|口服|静脉|疗程|(?:用药|给药|治疗|化疗|放疗)方案)"
ROUTE = r"(?i)方案|口服|静脉|疗程|给药|regimen|dose|dosage|\biv\b|\bpo\b"
SENTENCE_ENDS = r"(?<=[.!?])\d{1,4}\s+(?=[A-Z\"'])|(?<=[.!?])\s+(?=[A-Z0-9\"'])|(?<=[。！？；])\s*|(?<=[遥])\s*|(?<=曰)\s*(?=[(（\dA-Z一二三四五六七八九十])"
SEPARATOR = r"(?m)^\s*\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|?\s*$"
MISREAD = "窑源园圆员缘远苑愿怨援袁暂咱渊冤遥郾蚤灶则凿葬泽糟酝藻贼燥增"
REFERENCES = ("references", "reference", "bibliography", "参考文献")
BOILERPLATE = ("conflict of interest", "conflicts of interest", "author contribution", "acknowledgment", "acknowledgement", "funding", "research funding", "research support", "open access", "publisher's note", "copyright", "creative commons", "orcid")
TAILS = r"(?im)^\s*参\s*$\s*^\s*考\s*$\s*^\s*文\s*$\s*^\s*献\s*$|^\s*参考文献\s*$|^\s*利益冲突|利\s*益\s*冲\s*突|参\s*考\s*文\s*献\s*\[|^\s*(?:conflicts?\s+of\s+interest|author contributions?|acknowledg(?:e)?ments?|funding|open access|publisher'?s note|copyright|creative commons)\b"
UNIT_STARTS = r"(?m)\n\s*\n|(?=^\s*(?:推荐意见|推荐说明|临床问题|问题\s*\d+|Practice Point|Recommendation:|Recommendations?:|Table\s+\d+|表\s*\d+))"
CITED_TAIL = r"(?is)(?:^|\s)(?:\[\d{1,4}\]|\d{1,4}[\).]?)\s*[一-鿿A-Z][^。\n]{0,360}\[J\]"
CONTEXTS = r"(?i)^(?:(?:续表|表)\s*\d+|table |continued table|figure |fig\. |decision tree|suggested questions)"
AFFILIATION = r"(?i)\b(?:university|hospital|department|institute|school|faculty|college|center|centre|clinic|association|society|foundation|ministry|laborator(?:y|ies))\b"
#: Budgets, boosts of types, words that are indexed with a type, variants of queries.
BUNDLE, EVIDENCE, LONG_UNIT, KEPT_SENTENCES = 2500, 2, 1200, 3
BOOSTS = {"recommendation": 0.18, "recommendation_bundle": 0.22, "clinical_detail": 0.10}
KEYWORDS = {"recommendation": "recommend recommendation guideline suggest should advised treatment", "recommendation_bundle": "recommend recommendation guideline suggest should advised treatment", "clinical_detail": "dose dosage regimen mg mcg ml iv po percent table", "general": "guideline section evidence background"}
SYNONYMS = {"kidney transplant": ["renal transplant", "kidney transplantation", "肾脏移植", "肾移植"], "kidney transplantation": ["kidney transplant", "renal transplant", "肾脏移植", "肾移植"], "left ventricular ejection fraction": ["LVEF", "左心室射血分数", "左室射血分数"], "pneumonia": ["CAP", "community acquired pneumonia", "respiratory infection"], "antibiotic": ["antimicrobial", "antibacterial", "empiric therapy"],
            "antibiotics": ["antimicrobials", "antibacterials", "empiric therapy"], "hypertension": ["high blood pressure"], "diabetes": ["hyperglycemia"], "myocardial infarction": ["MI", "heart attack"], "acetaminophen": ["paracetamol"]}
BILINGUAL = {"left ventricular ejection fraction": "左心室射血分数", "ejection fraction": "射血分数", "below 40": "低于40%", "less than 40": "低于40%", "kidney transplant": "肾脏移植", "kidney transplantation": "肾脏移植", "renal transplant": "肾移植"}
NO_PHRASE = ("guideline", "recommendation", "recommend", "suggest", "treatment", "therapy", "指南", "推荐", "建议", "治疗")

_ADVICE, _DOSE, _DETAIL, _ROUTE, _ENDS, _SEPARATOR, _TAILS, _UNITS, _CITED, _CONTEXTS, _AFFILIATION = map(re.compile, (ADVICE, DOSE, DETAIL, ROUTE, SENTENCE_ENDS, SEPARATOR, TAILS, UNIT_STARTS, CITED_TAIL, CONTEXTS, AFFILIATION))
_SIGNAL, _ASCII, _VOWELS, _CJK, _USUAL = re.compile(r"[^\W_]"), re.compile("[A-Za-z]"), re.compile("[aeiouAEIOU]"), re.compile("[一-鿿]"), re.compile(r"[.,;:()\[\]{}<>/%+\-=|#*'\"$&!?_\\]")


class Facts:
    """Measures of a text, each taken when a gate asks for it."""

    def __init__(self, text: str):
        self.text = text.strip()

    @cached_property
    def flat(self) -> str:
        return " ".join(self.text.split())

    @cached_property
    def dense(self) -> str:
        return "".join(self.text.split())

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in map(str.strip, self.text.splitlines()) if x]

    def share(self, pattern: re.Pattern[str]) -> float:
        return len(pattern.findall(self.dense)) / max(1, len(self.dense))

    @cached_property
    def signs(self) -> float:
        return 1.0 - self.share(_SIGNAL)

    @cached_property
    def spaces(self) -> float:
        return sum(map(str.isspace, self.text)) / max(1, len(self.text))

    @cached_property
    def separated(self) -> bool:
        return bool(_SEPARATOR.search(self.text))


def _page_number(f: Facts) -> bool:
    return bool(re.fullmatch(r"(?i)(?:page\s*)?\d{1,4}", f.text))


def _reference_list(f: Facts) -> bool:
    x, journals = f.flat, len(re.findall(r"(?i)\[j\]", f.flat))
    if len(x) >= 120 and journals and re.match(r"(?i)\[\d{1,4}\]\s+[A-Z].{0,360}\[j\]", x) or len(x) >= 150 and journals >= 2 and len(re.findall(r"\[\d{1,4}\]", x)) >= 2:
        return True
    names = r"(?:^|[\s;])(?:\d{1,4}[\).]?|\[\d{1,4}\])\s+[A-Z][A-Za-zÀ-ž'’-]+(?:\s+[A-Z][A-Za-zÀ-ž'’-]+){0,4},"
    return len(x) >= 400 and len(re.findall(r"\b(?:J|Journal|Lancet|BMJ|Cochrane|Circulation|Eur|Clin)\b", x)) >= 2 and len(re.findall(names, x)) >= 4


def _garbled(f: Facts) -> bool:
    if len(f.dense) < 300:
        return False
    han = len(_CJK.findall(f.dense))
    if han and sum(f.dense.count(c) for c in set(MISREAD)) > 0.25 * han or f.signs > 0.35 and f.spaces < 0.08:
        return True
    letters = _ASCII.findall(f.dense)
    return len(letters) > 100 and f.signs > 0.30 and f.spaces < 0.12 and len(_VOWELS.findall(f.dense)) < 0.22 * len(letters)


def _noise(f: Facts) -> bool:
    if len(f.dense) < 120:
        return False
    unusual = f.signs - f.share(_USUAL)
    controls = sum(c < " " or "\x7f" <= c <= "\x9f" for c in f.dense) / len(f.dense)
    return controls > 0.01 or f.signs > 0.35 and unusual > 0.12 or f.signs > 0.50 and unusual > 0.02


def _glossary(f: Facts) -> bool:
    return len(f.text) >= 180 and len(re.findall(r"\b[A-Z][A-Z0-9⁃-]{1,9}\s*[:：]", f.text)) >= 6


def _data_structure(f: Facts) -> bool:
    if _DOSE.search(f.text):
        return False
    marks = sum(map(f.text.count, ("数据", "信息", "模块", "结构", "标准")))
    return "治疗方案制定" in f.text and marks >= 2 or bool(re.search(r"不(?:包含|含有|涉及|提供|包括).{0,8}剂量", f.text)) or len(f.text) >= 500 and marks >= 12


def _table(f: Facts) -> bool:
    return len(f.lines) >= 2 and f.separated or sum(x.count("|") >= 2 for x in f.lines) >= 2


def _affiliations(f: Facts) -> bool:
    if "%" in f.text or _DOSE.search(f.text) or len(f.lines) < 8 or not _table(f):
        return False
    named = sum(map(bool, map(_AFFILIATION.search, f.lines)))
    numbered = sum(bool(re.search(r"(?:^|\|)\s*\d{1,3}[A-Z]", x)) for x in f.lines)
    return numbered >= 2 and named >= max(5, len(f.lines) // 4) or named >= 2 and len(re.findall(r"\b(?:MD|PhD|MBBS|MSc|MPH|FRCP|FRCPC)\b", f.text)) >= 5


def _contributors(f: Facts) -> bool:
    if len(f.text) < 80:
        return False
    return len(re.findall(r"[一-鿿]{2,4}\([^)]*(?:医院|大学|科|中心)[^)]*\)", f.text)) >= 5 or len(re.findall(r"\b[A-Z][A-Za-z'.-]+(?:\s+[A-Z][A-Za-z'.-]+){0,3},\s*(?:MD|PhD|MBBS|MPH|MSc)\b", f.text)) >= 5


def _percents(f: Facts) -> bool:
    if "%" not in f.text:
        return False
    return len(f.lines) > 1 and any("%" in x and re.search(r"\s{2,}|\t|[:：]", x) for x in f.lines) or len(f.flat) <= 240 and bool(re.match(r"(?:[-*]\s*)?(?:[\w /-]{1,50}[:：]|\d+[\).])", f.flat))


def _short(f: Facts) -> bool:
    x = f.flat.strip("。.;")
    return not _DOSE.search(x) and len(x) < 16 and not (len(x) >= 8 and re.search(r"\d", x) and _ROUTE.search(x))


def _boilerplate(f: Facts) -> bool:
    return not f.flat or f.flat.lower().startswith(("references", "bibliography", *BOILERPLATE[:6], *BOILERPLATE[8:12])) or f.dense.startswith(("参考文献", "利益冲突"))


#: Gates by name, over a text's measures.
GATES: dict[str, Callable[[Facts], bool]] = {
    "empty": lambda f: not f.text, "page_number": _page_number, "reference_list": _reference_list, "garbled": lambda f: not f.separated and _garbled(f), "noise": _noise, "glossary": _glossary, "data_structure": _data_structure, "affiliations": _affiliations,
    "contributors": _contributors, "table": _table, "percents": _percents, "short": _short, "route_alone": lambda f: f.text.lower().strip(".:;") in ("iv", "po"), "boilerplate": _boilerplate, "context": lambda f: not f.flat or bool(_CONTEXTS.match(f.flat)) or _contributors(f),
}


def held_by(text: str, *gates: str) -> bool:
    f = Facts(text)
    return any(GATES[g](f) for g in gates)


def in_references(path: list[str]) -> bool:
    """Whether a heading says that what follows is no content, with or without its number."""
    for heading in path:
        h = " ".join(heading.lower().split()).strip(" |-:：")
        for x in {h, re.sub(r"^(?:\d+(?:\.\d+)*|[ivx]+)[\).]?\s+", "", h)}:
            if x in REFERENCES or x.startswith(("references ", "bibliography ", "参考文献")) or "references and resources" in h or x != h and x.startswith(BOILERPLATE) or x == h and h.startswith(BOILERPLATE):
                return True
    return False


def trimmed(text: str) -> str:
    """Without lines that are page numbers, up to where references or notes on interests begin."""
    kept = "\n".join(x for x in text.splitlines() if not held_by(x, "page_number")).strip()
    m = _TAILS.search(kept)
    return kept[: m.start()].strip() if m else kept


def distinct(texts: list[str]) -> list[str]:
    """Squeezed; of those that differ in case alone the first."""
    flat = [" ".join(x.split()) for x in texts]
    return list({x.lower(): x for x in reversed(flat) if x}.values())[::-1]


def sentences(text: str) -> list[str]:
    """Lines of a text of several, sentences of each."""
    lines = [x.strip(" -*\t") for x in text.splitlines() if x.strip()] if text.count("\n") else [text]
    return [x for line in lines for x in map(str.strip, _ENDS.split(line.strip())) if x]


def advice(text: str) -> list[str]:
    """Sentences that recommend."""
    return distinct([s for s in sentences(text) if _ADVICE.search(s) and not held_by(s, "glossary", "data_structure")])


def details(text: str) -> list[str]:
    """Tables, and sentences with doses, routes or percentages; long ones at their semicolons."""
    if held_by(text, "empty", "garbled", "noise", "glossary", "data_structure", "affiliations"):
        return []
    if held_by(text, "table"):
        return [text.strip()]
    some = [x for s in sentences(text) for x in (re.split(r";\s*", s) if len(s) >= 500 and len(_DETAIL.findall(s)) >= 2 else [s])]
    return distinct([x.strip() for x in some if (_DETAIL.search(x) or held_by(x, "percents")) and not held_by(x, "route_alone", "short", "noise", "glossary", "data_structure")])


def evidence(text: str) -> list[str]:
    """Units of what follows a recommendation, up to references or notes; long units by their first sentences."""
    out = []
    for raw in filter(str.strip, _UNITS.split(trimmed(text))):
        unit = trimmed(raw)
        m = _CITED.search(unit)
        before = unit[: m.start()].strip() if m else unit
        unit = before if not before or len(before) >= 40 or not m else unit
        if held_by(unit, "empty", "boilerplate", "reference_list"):
            break
        if not held_by(unit, "context"):
            some = sentences(unit) if len(unit) > LONG_UNIT else []
            out.append(" ".join(some[:KEPT_SENTENCES]) if len(some) > KEPT_SENTENCES else unit)
    return distinct(out)


def bundle(recommendation: str, units: list[str]) -> str:
    return recommendation + ("\n\nEvidence:\n" + "\n\n".join(units) if units else "")


def bundles(recommendation: str, units: list[str]) -> list[list[str]]:
    """Evidence in groups that fit a bundle with their recommendation; a unit that doesn't fit is cut at sentences, or list items."""
    if len(bundle(recommendation, units)) <= BUNDLE:
        return [units]
    cut_: list[str] = []
    for u in units:
        parts = [u]
        if len(bundle(recommendation, [u])) > BUNDLE:
            parts = sentences(u)
            if len(parts) < 2:
                parts = list(filter(None, map(str.strip, re.split(r";\s*|；\s*|(?=\(\d+\))|(?=\b\d{1,2}[\).]\s+)|(?=•\s*)", u))))
            if len(parts) < 2 and len(u) > 900 and u.count(",") >= 5:
                parts = list(filter(None, map(str.strip, u.split(","))))
        cut_ += parts
    room = BUNDLE - len(bundle(recommendation, [""])) + 2
    return [cut_[i:j] for i, j in budgets(np.array([len(x) + 2 for x in cut_], np.int64), None, room)] or [[]]


CHUNKS = "chunk_type string, text string, section_path array<string>, recommendation string, evidence array<string>, order_index int, chunk_number int"


def find_chunks(of: dict[str, list]) -> tuple[list[int], dict[str, list]]:
    row, b = find_blocks(of)
    rows: list[int] = []
    out: dict[str, list] = {f.split()[0]: [] for f in CHUNKS.split(", ")}
    row_ = np.array(row, np.int64)
    for r, title in enumerate(of["title"]):
        lo, hi = np.searchsorted(row_, [r, r + 1])
        kind, path, text = b["kind"][lo:hi], b["heading_path"][lo:hi], b["text"][lo:hi]
        skip = [k == "heading" or in_references(p) or held_by(x, "empty", "page_number", "reference_list", "garbled") for k, p, x in zip(kind, path, text)]
        clean = ["" if s else trimmed(x) for s, x in zip(skip, text)]
        found: list[tuple] = []
        rest: list[tuple] = []
        for i, x in enumerate(clean):
            if not x:
                continue
            own, recommends = details(x), advice(x)
            found += [("clinical_detail", d, i, None, []) for d in own]
            units: list[str] = []
            if recommends:  # what follows under the same headings, up to references
                for j in range(i + 1, hi - lo):
                    if kind[j] == "heading" or path[j] != path[i] or len(units) >= EVIDENCE or kind[j] == "text" and held_by(text[j], "reference_list", "boilerplate"):
                        break
                    if clean[j] and kind[j] == "text":
                        units += evidence(clean[j])
                units = units[:EVIDENCE]
            for s in recommends:
                found += [("recommendation_bundle" if g else "recommendation", bundle(s, g), i, s, g) for g in bundles(s, units)]
            if not recommends and own != [x]:
                rest.append(("general", x, i, None, []))
        found += rest
        if not found:
            head = next((t for k, t in zip(kind, text) if k == "heading"), None)
            found = [("general", head or title or str(of["key"][r]), 0, None, [])]
            path = [[found[0][1]]]
        for n, (kind_, x, i, rec, units) in enumerate(found):
            for name, v in zip(out, (kind_, x, path[i] or [title or str(of["key"][r])], rec, units, i, n)):
                out[name].append(v)
        rows += [r] * len(found)
    return rows, out


def structural_chunks(documents: DataFrame, body: str, title: str, key: str) -> DataFrame:
    """(key, chunk_id, chunk_type, text, section_path, recommendation, evidence, order_index, text_for_embedding): one pass, no shuffle."""
    x = expand(documents, {"text": body, "title": title, "key": key}, [key], CHUNKS, find_chunks, rows=32)
    k = F.col(key).cast("string")
    digest = F.sha1(F.concat_ws(":", k, "chunk_type", "order_index", "chunk_number", F.substring("text", 1, 120)))
    whole = F.concat(F.lit("[GUIDELINE SECTION]: "), F.array_join("section_path", " > "), F.lit("\n[CHUNK TYPE]: "), F.col("chunk_type"), F.lit("\n[CONTENT]:\n"), F.col("text"))
    return x.withColumns({"chunk_id": F.concat_ws("_", k, "chunk_type", F.substring(digest, 1, 12)), "text_for_embedding": whole}).drop("chunk_number")


def indexed_text() -> Column:
    """What BM25 reads of a chunk: its path, its type with words of that type, and its text."""
    words = F.create_map(*[F.lit(x) for kv in KEYWORDS.items() for x in kv])
    return F.concat_ws("\n", F.array_join("section_path", " > "), "chunk_type", F.coalesce(F.try_element_at(words, F.col("chunk_type")), F.lit("")), "text")


def variants(query: str) -> list[str]:
    return expand_query(query, SYNONYMS, bilingual=BILINGUAL)


def ranked_lists(chunks: DataFrame, queries: list[str], k: int = 50) -> DataFrame:
    """(id, channel, rank): the first k by BM25 and by the hashing encoder, of each query. One scan turns texts into numbers for all queries."""
    each = [Counter(re.findall(TOKEN, q.lower())) for q in queries]
    terms = sorted(set().union(*each))
    numbers = term_frequencies(chunks.withColumn("__text", indexed_text()), "__text", terms)
    numbers = cut(numbers.select("chunk_id", "dl", "tf", text_similarity("text_for_embedding", [hash_vector(q) for q in queries]).alias("close")))
    stats = numbers.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col("tf")[i] > 0).alias(f"df{i}") for i in range(len(terms))])
    x = numbers.crossJoin(F.broadcast(stats))  # a stated one-row aggregate
    dl = F.greatest("dl", F.lit(1)).cast("double")
    out = None
    for q, counts in enumerate(each):
        score = F.lit(0.0)
        for t, n in counts.items():
            i = terms.index(t)
            f, d = F.col("tf")[i].cast("double"), F.col(f"df{i}")
            idf = F.log(F.lit(1.0) + (F.col("n") - d + F.lit(0.5)) / (d + F.lit(0.5)))
            score = score + F.lit(float(n)) * idf * (f * F.lit(K1 + 1)) / (f + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * dl / F.greatest("avgdl", F.lit(1.0))))
        for name, s in (("bm25", F.round(score, 6)), ("dense", F.round(F.col("close")[q], 6))):
            scored = x.select("chunk_id", s.alias("score"))
            top = (scored.filter("score > 0") if name == "bm25" else scored).orderBy(F.desc("score"), "chunk_id").limit(k)
            one = fusion.ranked(top, "chunk_id", f"{name} {q}")
            out = one if out is None else out.unionByName(one)
    return out


def rule_scores(query: str, queries: list[str]) -> Column:
    """The re-ranker's score of a candidate (section_path, chunk_type, text, evidence, score)."""
    whole = F.lower(F.concat_ws(" ", F.array_join("section_path", " > "), "chunk_type", "text", F.array_join(F.coalesce("evidence", F.array().cast("array<string>")), " ")))
    terms = sorted({t for q in queries for t in re.findall(TOKEN, q.lower())})
    phrases = sorted({p for q in queries for p in q.lower().split() if p not in NO_PHRASE and len(p) >= 3 and _CJK.search(p)})
    hits = sum((F.when(whole.contains(p), 1).otherwise(0) for p in phrases), F.lit(0))
    exact = F.when(whole.contains(query.lower()), 0.25)
    for q in queries[1:]:
        exact = exact.when(whole.contains(q.lower()), 0.18)
    types = F.create_map(*[F.lit(x) for kv in BOOSTS.items() for x in kv])
    boost = F.coalesce(F.try_element_at(types, F.col("chunk_type")), F.lit(0.0)) + exact.otherwise(0.0) + F.least(F.lit(0.35), hits * F.lit(0.08))
    overlap = token_overlap(F.array(*[F.lit(t) for t in terms]), tokens(whole))
    return F.round(F.col("score") * (F.lit(1.0) + boost + F.least(F.lit(0.30), overlap * F.lit(0.30))) + F.least(F.lit(0.04), hits * F.lit(0.01)), 6)


def search(chunks: DataFrame, query: str, k: int = 10, *, depth: int = 50, fused: int = 100, scorer: Scorer | None = None) -> DataFrame:
    """The first k chunks for a query and its variants. scorer: a model's, blended with the rules' score; where it fails, the rules stand."""
    queries = variants(query)
    if not queries:
        return chunks.limit(0).withColumn("score", F.lit(0.0))
    top = fusion.rrf(ranked_lists(chunks, queries, depth)).withColumnRenamed("id", "chunk_id").orderBy(F.desc("score"), "chunk_id").limit(fused)
    x = payload(top, chunks.withColumn("__at", F.lit(0)), "chunk_id", ["chunk_type", "text", "section_path", "evidence", "text_for_embedding"], "__at")
    x = x.withColumn("score", rule_scores(" ".join(query.split()), queries))
    if scorer:
        m = fusion.minmax(model_scores(x, query, "text_for_embedding", scorer), "model_score", "__m", equal="one")
        x = m.withColumn("score", F.when(F.col("model_score").isNull(), F.col("score")).otherwise(F.round(F.lit(0.85) * F.col("__m") + F.lit(0.15) * F.col("score"), 6))).drop("__m", "model_score", "model_error")
    return x.orderBy(F.desc("score"), "chunk_id").limit(k)
