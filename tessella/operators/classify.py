"""Rules that classify sections, chunks, blocks and departments, as ordered conditions or as a rule table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.batches import expand

#: Patterns of section types in the order in which they are tried.
SECTION_RULES = (
    ("recommendation", r"(?i)(recommendation|recommendations|we recommend|we suggest|should be|is recommended|推荐|建议|应该|宜|不建议)"),
    ("scope_population", r"(?i)(scope|population|target population|intended audience|applicability|eligib|范围|适用|人群|目标人群|适用对象)"),
    ("pico", r"(?i)(\bPICO\b|clinical question|key question|research question|patient.?intervention|临床问题|循证问题|关键问题)"),
    ("evidence", r"(?i)(evidence|certainty|quality of evidence|systematic review|meta-analysis|GRADE|证据|证据质量|证据等级|系统评价|荟萃)"),
    ("table", r"(?i)(\btable\b|\bfig(?:ure)?\b|\balgorithm\b|表\s*\d*|图\s*\d*|流程)"),
    ("conclusion", r"(?i)(conclusion|summary|take-home|key points|结论|总结|要点)"),
    ("background", r"(?i)(background|introduction|epidemiology|背景|前言|引言)"),
)
REFERENCE = r"(?i)^(references|bibliography|参考文献)$"
TYPE_WEIGHTS = {"recommendation": 1.55, "table": 1.35, "pico": 1.25, "evidence": 1.2, "scope_population": 1.05, "conclusion": 1.0, "background": 0.5, "reference": 0.1, "other": 0.9}
#: Patterns of block types in the order in which they are tried.
LOW_VALUE = r"(?i)\b(references|bibliography|methods|conflict of interest|declaration|acknowledgements|copyright|appendix index|table of contents)\b"
BLOCK_RULES = (
    ("reference", r"(?i)\b(references|bibliography|appendix)\b"),
    ("method", r"(?i)\b(methods|methodology|search strategy|conflict of interest|funding|declaration)\b"),
    ("scope_candidate", r"(?i)\b(scope|target population|applicability|inclusion|exclusion|who this guideline is for|who should use this guideline)\b"),
    ("population_candidate", r"(?i)\b(target population|population|intended audience)\b"),
    ("recommendation_candidate", r"(?i)\b(recommendation|recommendations|we recommend|we suggest|should|should not|offer|do not offer|consider|do not routinely|is recommended|is not recommended|strong recommendation|conditional recommendation|good practice statement)\b"),
    ("rationale_candidate", r"(?i)\b(rationale|evidence to decision|EtD|committee discussion|committee considerations|benefits and harms|values and preferences|resource use|equity|acceptability|feasibility|implementation considerations)\b"),
    ("evidence_candidate", r"(?i)\b(evidence|evidence summary|summary of evidence|quality of evidence|certainty of evidence|GRADE|evidence profile|summary of findings|risk of bias|imprecision|inconsistency|indirectness|publication bias|effect estimate|relative effect|absolute effect|confidence interval)\b"),
    ("pico_candidate", r"(?i)\b(PICO|review question|clinical question|key question|population|intervention|comparator|outcome|outcomes)\b"),
    ("algorithm_candidate", r"(?i)\b(algorithm|pathway|flowchart|flow chart|decision tree|流程|路径)\b"),
    ("abstract", r"(?i)\b(abstract|summary)\b"),
    ("background", r"(?i)\b(background|introduction|overview|epidemiology)\b"),
)


def section_type(heading: Column, path: Column, content: Column) -> Column:
    joined = F.array_join(F.coalesce(path, F.array().cast("array<string>")), " ")
    head = F.coalesce(F.nullif(heading, F.lit("")), joined)
    hay = F.concat(head, F.lit("\n"), joined, F.lit("\n"), F.substring(F.coalesce(content, F.lit("")), 1, 1200))
    out = F.when(F.trim(head).rlike(REFERENCE), "reference")
    for name, pattern in SECTION_RULES:
        out = out.when(hay.rlike(pattern), name)
    return out.otherwise("other")


def chunk_type(given: Column, is_reference: Column, path: Column, content: Column) -> Column:
    """The given type where there is one."""
    own = F.trim(F.coalesce(given, F.lit("")))
    return F.when(own != "", own).when(F.coalesce(is_reference, F.lit(False)), "reference").otherwise(section_type(F.coalesce(F.try_element_at(path, F.lit(-1)), F.lit("")), path, content))


def type_weight(t: Column) -> Column:
    m = F.create_map(*[x for k, v in TYPE_WEIGHTS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, t), F.lit(TYPE_WEIGHTS["other"]))


def block_type(text: Column, path: Column) -> Column:
    both = F.trim(F.concat(F.array_join(path, " > "), F.lit("\n"), text))
    pico = sum((F.lower(text).contains(w).cast("int") for w in ("intervention", "comparator", "outcome")), F.lower(text).contains("population").cast("int")) >= 2
    out = F.when((F.size(path) == 0) & ~F.trim(text).contains("\n") & (F.length(text) < 180), "title")
    for name, pattern in BLOCK_RULES:
        hit = both.rlike(pattern)
        if name == "population_candidate":
            hit = hit & ~pico
        if name == "recommendation_candidate":
            hit = hit & ~both.rlike(LOW_VALUE)
        out = out.when(hit, name)
    return out.otherwise("unknown")


#: Rules that are held by the workers; more are an error.
MOST_RULES = 1_000_000


def keyword_scores(df: DataFrame, id_col: str, title: Column, body: Column, rules: Sequence[tuple[str, str, float, float]]) -> DataFrame:
    """(id, position, label, score). rules: (label, keyword, title bonus, body weight); a keyword counts once where it is present, a Latin one
    only between characters that aren't Latin letters or digits. One automaton of all keywords reads each text once, so that the work
    doesn't grow with the rules; documents are scanned without a join."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are more than {MOST_RULES}")
    spark = df.sparkSession
    if not rules:
        return df.select(id_col, F.lit(0).alias("position"), F.lit("").alias("label"), F.lit(0.0).alias("score")).limit(0)
    order = list(dict.fromkeys(r[0] for r in rules))
    held = spark.sparkContext.broadcast([(order.index(a), k.lower(), float(b), float(w)) for a, k, b, w in rules])

    def find(of: dict[str, list]) -> tuple[list[int], dict[str, list]]:
        automaton = _automaton(held)
        rows: list[int] = []
        out: dict[str, list] = {"position": [], "label": [], "score": []}
        for r, (t, b) in enumerate(zip(of["title"], of["body"])):
            sums: dict[int, float] = {}
            for text, which in ((t, 2), (b, 3)):
                for i in _present(automaton, (text or "").lower()):
                    rule = held.value[i]
                    sums[rule[0]] = sums.get(rule[0], 0.0) + rule[which]
            for at, s in sorted(sums.items()):
                if s > 0:
                    rows.append(r)
                    for n, v in (("position", at), ("label", order[at]), ("score", s)):
                        out[n].append(v)
        return rows, out

    x = df.select(id_col, title.alias("__title"), body.alias("__body"))
    return expand(x, {"title": "__title", "body": "__body"}, [id_col], "position int, label string, score double", find)


_AUTOMATA: dict[int, object] = {}


def _automaton(held):
    """Made once in a worker for a broadcast table."""
    if (found := _AUTOMATA.get(id(held.value))) is None:
        import ahocorasick

        found = ahocorasick.Automaton()
        by: dict[str, list[int]] = {}
        for i, (_, k, *_) in enumerate(held.value):
            by.setdefault(k, []).append(i)
        for k, at in by.items():
            if k:
                found.add_word(k, (k, at))
        found.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[id(held.value)] = found
    return found


def _latin(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def _present(automaton, text: str) -> set[int]:
    out: set[int] = set()
    if not len(automaton):
        return out
    for end, (k, at) in automaton.iter(text):
        if out.issuperset(at):
            continue
        start = end - len(k) + 1
        if any("一" <= c <= "鿿" for c in k) or not (start and _latin(text[start - 1]) or end + 1 < len(text) and _latin(text[end + 1])):
            out.update(at)
    return out


def labels(scores: DataFrame, id_col: str, ratio: float = 0.35, least: float = 2.0) -> DataFrame:
    """(id, labels): those with at least max(least, ratio * top), by falling score."""
    top = scores.groupBy(id_col).agg(F.max("score").alias("top"), F.collect_list(F.struct((-F.col("score")).alias("s"), "position", "label")).alias("all"))
    kept = F.filter(F.array_sort("all"), lambda e: -e["s"] >= F.greatest(F.lit(float(least)), F.col("top") * F.lit(float(ratio))))
    first = F.slice(F.array_sort("all"), 1, 1)
    return top.select(id_col, F.transform(F.when(F.size(kept) > 0, kept).otherwise(first), lambda e: e["label"]).alias("labels"))


def restrict(own: Column, parent: Column, unclassified: str = "未分类") -> Column:
    """Labels of a part that its document has too, else the document's first."""
    both = F.array_intersect(own, parent)
    return F.when(F.size(both) > 0, both).otherwise(F.array(F.coalesce(F.try_element_at(parent, F.lit(1)), F.lit(unclassified))))


def source_by_path(path: Column, hints: dict[str, str], default: str = "Unknown") -> Column:
    """The institution that the first known folder of a path names; a _pdf suffix is ignored."""
    m = F.create_map(*[x for k, v in hints.items() for x in (F.lit(k.lower()), F.lit(v))])
    parts = F.transform(F.split(F.regexp_replace(path, r"\\", "/"), "/"), lambda p: F.regexp_replace(F.lower(p), r"_pdf$", ""))
    found = F.filter(F.transform(parts, lambda p: F.try_element_at(m, p)), lambda v: v.isNotNull())
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(default))
