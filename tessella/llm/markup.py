"""Problem 6: left-over HTML, wiki or LaTeX markup in Markdown bodies and chunks, to clean Markdown.

A text is read as a stream of events: the standard library's streaming HTML parser gives tags, comments and entities, with signs
that only resemble one shielded from it by the names of HTML's elements and entities; scanners give the constructs of
wikis and LaTeX. A text holds markup if its stream has an event, and of the kinds of its events. From the events each source
line has a ratio of text to tags; smoothed with a Gaussian, the ratios are clustered in two around a threshold, in every text
with markup, whatever its size. Outside content regions, lines go that hold nothing but links; lines of tables, lists, code,
formulas, headings and prose never do. Headings, lists, tables and code blocks come out as Markdown, formulas as $...$;
scripts, styles, comments, citations and reference marks go.

Defined results: null stays null, and text without markup comes out unchanged, whatever its length. Fenced and inline
code is not read as markup. Page markers <!-- page: N --> stay. Unclosed tags end with the text. Markup alone gives an empty text.
"""

from __future__ import annotations

import html
import html.entities
import re
from bisect import bisect_left
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tessella.llm.arrow import through
from tessella.llm.tables import texts

#: Names of HTML elements, and of the tags of wikis.
ELEMENTS = frozenset(
    "a abbr acronym address article aside audio b big blockquote body br button canvas caption center cite code col colgroup dd del details dfn dialog div dl dt em embed fieldset figcaption figure font footer form frame "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript object ol optgroup option p param picture pre q s samp script section select small "
    "source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr ref references nowiki math gallery".split()
)
#: LaTeX commands that mark up text or stand in formulas.
COMMANDS = frozenset(
    "begin end item section subsection subsubsection chapter paragraph textbf textit texttt textsc textrm emph underline cite citep citet ref label caption footnote url href includegraphics hline toprule midrule bottomrule "
    "SI si num qty unit frac dfrac sqrt sum int prod cdot times div pm leq geq le ge neq approx infty alpha beta gamma delta epsilon lambda mu pi sigma tau phi chi omega theta Delta Sigma Omega Gamma Phi mathrm mathbf mathit text left "
    "right overline bar hat vec log ln exp min max lim quad milli micro kilo gram litre liter metre meter second mole newline par noindent centering title author date maketitle documentclass usepackage mbox ldots dots bibitem vspace hspace".split()
)
_ATTR = r"(?:\s+[A-Za-z_:][\w:.-]*(?:\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>=`]+))?)*"
TAG = re.compile(rf"</?([A-Za-z][A-Za-z0-9]*){_ATTR}\s*/?>")
COMMENT = re.compile(r"<!--(?!\s*page:\s*\d+\s*-->).*?-->|<!DOCTYPE[^>]*>|<\?xml[^>]*\?>", re.S | re.I)
ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
WIKI = re.compile(r"\[\[[^\[\]\n]+\]\]|\{\{[^{}\n]+\}\}|'''[^'\n]+'''|(?<![\d'])''(?=[^\s'])[^'\n]+''(?!')|^(={2,6})[ \t]*[^=\n]+?[ \t]*\1[ \t]*$|^\{\||^\|\}|^\|-[ \t]*$|^!.*!!|^\*{2,}[ \t]+\S", re.M)
COMMAND = re.compile(r"(?<![\w:\\])\\([A-Za-z]+)\*?(?![A-Za-z_])")
MATH = re.compile(r"\\\[.*?\\\]|\\\(.*?\\\)|\$\$[^$]+\$\$|\$[^$\n]*(?:\\[A-Za-z]+|[\^_]\{)[^$\n]*\$", re.S)
ROW = re.compile(r"^[^|\n]*&[^|\n]*\\\\[ \t]*$", re.M)
CODE = re.compile(r"^(```|~~~)[^\n]*\n.*?(?:^\1[ \t]*$|\Z)|`[^`\n]+`", re.M | re.S)
_WIKI_SIGNS = ("[[", "{{", "''", "\n==", "\n{|", "\n|}", "\n|-", "!!", "\n**")
_WIKI_STARTS = ("==", "{|", "|}", "|-", "**")
_PAGE = re.compile(r"<!--\s*page:\s*(\d+)\s*-->")
_SHIELD = re.compile(rf"{_PAGE.pattern}|(?P<comment>(?si:{COMMENT.pattern}))|{TAG.pattern}|{ENTITY.pattern}|<|&")
_MARKS = {"\0l\0": "<", "\0a\0": "&"}


_SUP, _SUB = str.maketrans("0123456789+-", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻"), str.maketrans("0123456789+-", "₀₁₂₃₄₅₆₇₈₉₊₋")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BREAK = {"p", "div", "ul", "ol", "table", "section", "article", "blockquote", "dl", "form", "figure"}


class _Markdown(HTMLParser):
    """Parser events to Markdown, with the text and tags of each source line counted."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.out: list[str] = []
        self.text: dict[int, int] = {}
        self.tags: dict[int, int] = {}
        self.events = 0
        self.skip = self.pre = 0
        self.lists: list[str] = []
        self.row: list[str] | None = None
        self.rows = 0
        self.small: str | None = None
        self.link = self.nav = False
        self.head = 0
        self.linked: dict[int, int] = {}
        self.held: set[int] = set()  # lines of tables, lists, code, formulas and headings
        self.depth: dict[int, int] = {}  # of each line, tags opened less tags closed

    def write(self, x: str) -> None:
        if self.small:
            x = x.translate(_SUP if self.small == "sup" else _SUB)
        if self.row is not None and self.row:
            self.row[-1] += x.replace("\n", " ")
        elif self.row is None or x.strip():
            self.out.append(x)

    def gap(self, n: int) -> None:
        while self.out and not self.out[-1]:
            self.out.pop()
        if self.out and self.row is None:
            tail = len(self.out[-1]) - len(self.out[-1].rstrip("\n")) if self.out[-1].strip("\n") else n
            self.out.append("\n" * max(0, n - tail))

    def event(self) -> int:
        """Counted, with the line it is on."""
        line = self.getpos()[0]
        self.tags[line] = self.tags.get(line, 0) + 1
        self.events += 1
        return line

    def handle_comment(self, data: str) -> None:
        self.event()

    def handle_decl(self, decl: str) -> None:
        self.event()

    def handle_pi(self, data: str) -> None:
        self.event()

    def count(self, tag: str, step: int) -> None:
        line = self.event()
        if tag not in _VOID:
            self.depth[line] = self.depth.get(line, 0) + step
        if tag == "a" or tag in _BREAK or tag in ("li", "tr", "td", "th"):  # a link left open ends with its block
            self.link = tag == "a" and step > 0
        elif tag == "nav":
            self.nav = step > 0
        elif re.fullmatch("h[1-6]", tag):
            self.head = max(0, self.head + step)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.count(tag, 1)
        if tag in ("script", "style", "noscript", "template"):
            self.skip += 1
        elif tag == "pre":
            self.gap(1)
            self.out.append("```\n")
            self.pre += 1
        elif re.fullmatch("h[1-6]", tag):
            self.gap(2)
            self.out.append("#" * int(tag[1]) + " ")
        elif tag == "li":
            self.gap(1)
            self.out.append("  " * max(0, len(self.lists) - 1) + ("1. " if self.lists[-1:] == ["ol"] else "- "))
        elif tag == "tr":
            self.end_row()
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.row.append("")
        elif tag in ("br", "hr"):
            self.write("\n" if self.row is None else " ")
        elif tag in ("sub", "sup"):
            self.small = tag
        elif tag in _BREAK:
            if tag in ("ul", "ol"):
                self.lists.append(tag)
            if tag == "table":
                self.rows = 0
            self.gap(1 if tag in ("ul", "ol") and len(self.lists) > 1 else 2)
        elif tag == "code" and not self.pre:
            self.write("`")

    def end_row(self) -> None:
        if self.row:
            cells = [c.strip().replace("|", "\\|") for c in self.row]
            self.row = None
            self.out.append(f"| {' | '.join(cells)} |\n" + ("|" + "---|" * len(cells) + "\n" if not self.rows else ""))
            self.rows += 1
        self.row = None

    def handle_endtag(self, tag: str) -> None:
        self.count(tag, -1)
        if tag in ("script", "style", "noscript", "template"):
            self.skip = max(0, self.skip - 1)
        elif tag == "pre" and self.pre:
            self.gap(1)
            self.out.append("```\n")
            self.pre -= 1
        elif tag in ("tr", "table"):
            self.end_row()
        elif tag in ("sub", "sup"):
            self.small = None
        elif tag == "code" and not self.pre:
            self.write("`")
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        if re.fullmatch("h[1-6]", tag) or tag in ("p", "div", "table", "blockquote"):
            self.gap(2 if tag != "div" else 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in ("br", "hr"):
            self.handle_starttag(tag, attrs)
        else:
            self.event()

    def handle_data(self, data: str) -> None:
        if not self.skip:
            line = self.getpos()[0]
            for i, part in enumerate(data.split("\n")):
                n = len(part.strip())
                self.text[line + i] = self.text.get(line + i, 0) + n
                if self.link or self.nav:
                    self.linked[line + i] = self.linked.get(line + i, 0) + n
                if self.row is not None or self.pre or self.head or self.lists and not self.nav or any(c in part for c in "$\\`|\0"):
                    self.held.add(line + i)
            self.write(data)

    def handle_entityref(self, name: str) -> None:
        self.events += 1
        self.handle_data(html.unescape(f"&{name};").replace("\xa0", " "))

    def handle_charref(self, name: str) -> None:
        self.events += 1
        self.handle_data(html.unescape(f"&#{name};").replace("\xa0", " "))


def content_lines(text: dict[int, int], tags: dict[int, int], sigma: float = 1.0) -> np.ndarray:
    """Which lines belong to content: text-to-tag ratios, smoothed, and split in two clusters around a threshold."""
    n = max([0, *text, *tags])
    ratio = np.array([text.get(i, 0) / max(1, tags.get(i, 0)) for i in range(1, n + 1)], float)
    if not n:
        return np.zeros(0, bool)
    r = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    smooth = np.convolve(ratio, kernel / kernel.sum())[r : r + n]
    low, high = smooth.min(), smooth.max()
    for _ in range(20):  # two means
        cut = (low + high) / 2
        a, b = smooth[smooth <= cut], smooth[smooth > cut]
        if not len(a) or not len(b) or (a.mean(), b.mean()) == (low, high):
            break
        low, high = a.mean(), b.mean()
    return smooth > min((low + high) / 2, smooth.std())


def _parsed(text: str) -> _Markdown:
    """The parser after it has read a text, in which signs that only resemble a tag or an entity are shielded."""

    def shield(m: re.Match[str]) -> str:
        x = m[0]
        if m["comment"]:
            return x
        if x[0] == "&":
            return x if len(x) > 1 and (x[1] == "#" or x[1:] in html.entities.html5) else "\0a\0" + x[1:]
        if page := _PAGE.fullmatch(x):
            return f"\0page {page[1]}\0"
        t = TAG.fullmatch(x)
        return x if t and t[1].lower() in ELEMENTS else "\0l\0" + x[1:].replace("&", "\0a\0")

    p = _Markdown()
    p.feed(_SHIELD.sub(shield, text))
    p.close()
    p.end_row()
    return p


def _unshielded(text: str) -> str:
    for mark, sign in _MARKS.items():
        text = text.replace(mark, sign)
    return re.sub("\0page (\\d+)\0", r"<!-- page: \1 -->", text)


class Stream:
    """The events of a text without its code: of which kinds of markup, how many on each line, and which lines are links alone."""

    def __init__(self, text: str):
        self.kinds: set[str] = set()
        self.html: _Markdown | None = None
        at: list[tuple[int, int]] = []  # where scanners' events start and end
        if any(x in text for x in _WIKI_SIGNS) or text.startswith(_WIKI_STARTS):
            at += [m.span() for m in WIKI.finditer(text)]
            if at:
                self.kinds.add("wiki")
        if "\\" in text or "$" in text:
            found = [m.span() for p in (MATH, ROW) for m in p.finditer(text)] + [m.span() for m in COMMAND.finditer(text) if m[1] in COMMANDS]
            at += found
            if found:
                self.kinds.add("latex")
        if "<" in text or "&" in text:
            self.html = _parsed(text)
            if self.html.events:
                self.kinds.add("html")
        self.text, self.tags = (self.html.text, self.html.tags) if self.html else ({}, {})
        if not self.kinds:
            return
        breaks = [m.start() for m in re.finditer("\n", text)]
        if not self.html:
            self.text = {i: len(x.strip()) for i, x in enumerate(text.split("\n"), 1)}
        for a, b in at:
            line = bisect_left(breaks, a) + 1
            self.tags[line] = self.tags.get(line, 0) + 1
            self.text[line] = max(0, self.text.get(line, 0) - (b - a))

    def outside(self) -> set[int]:
        """Lines of nothing but links that don't belong to content."""
        keep, p = content_lines(self.text, self.tags), self.html
        links = {i for i, n in p.linked.items() if n and n == p.text[i] and i not in p.held and not p.depth.get(i)} if p else set()
        return {i for i in links if not keep[i - 1]}


def kinds(text: str | None) -> set[str]:
    """Which of html, wiki and latex markup a text holds: those of its events."""
    return Stream(_bare(text.replace("\r\n", "\n"))).kinds if text and any(x in text for x in _SIGNS) else set()


_SIGNS = ("<", "&", "\\", "$", "[[", "{{", "''", "==", "{|", "|}", "|-", "!!", "**")


def _bare(text: str) -> str:
    return CODE.sub(lambda m: " " * len(m[0]), text) if "`" in text or "~~~" in text else text


def _html(text: str) -> str:
    return _unshielded("".join(_parsed(text).out))


_UNITS = {"milli": "m", "micro": "µ", "kilo": "k", "gram": "g", "litre": "L", "liter": "L", "metre": "m", "meter": "m", "second": "s", "mole": "mol"}


def _latex(text: str) -> str:
    text = re.sub(r"\\\[\s*(.*?)\s*\\\]|\\\(\s*(.*?)\s*\\\)", lambda m: f"${m[1] or m[2]}$", text, flags=re.S)
    held: list[str] = []

    def hold(m: re.Match[str]) -> str:
        held.append(m[0])
        return f"\0m{len(held) - 1}\0"

    text = MATH.sub(hold, text)
    text = re.sub(r"\\SI\{([^{}]*)\}\{((?:\\[a-z]+)+)\}", lambda m: m[1] + " " + "".join(_UNITS.get(u, u) for u in re.findall(r"\\([a-z]+)", m[2])), text)

    def tabular(m: re.Match[str]) -> str:
        rows = [[c.strip() for c in r.replace("\\hline", "").split("&")] for r in m[1].split("\\\\") if r.replace("\\hline", "").strip()]
        if not rows:
            return ""
        return "".join(f"| {' | '.join(r)} |\n" + ("|" + "---|" * len(r) + "\n" if not i else "") for i, r in enumerate(rows))

    text = re.sub(r"\\begin\{tabular\*?\}(?:\{[^{}]*\})?(.*?)\\end\{tabular\*?\}\n?", tabular, text, flags=re.S)
    text = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\]|\{[^{}]*\})?[ \t]*\n?", "", text)
    text = re.sub(r"^([ \t]*)\\item(?:\[[^\]]*\])?[ \t]*", r"\1- ", text, flags=re.M)
    text = re.sub(r"\\(sub)?(sub)?section\*?\{([^{}]*)\}", lambda m: "#" * (2 + bool(m[1]) + bool(m[2])) + " " + m[3], text)
    text = re.sub(r"~?\\(?:cite[pt]?|ref|label|footnote|includegraphics)(?:\[[^\]]*\])?\{[^{}]*\}", "", text)
    for _ in range(3):
        text = re.sub(r"\\(?:textbf|textit|texttt|textsc|textrm|emph|underline|text|mbox|caption|title|author|url)\{([^{}]*)\}", r"\1", text)
    text = re.sub(r"\\(?:hline|toprule|midrule|bottomrule|newline|par|noindent|centering|maketitle)\b[ \t]*", "", text)
    text = ROW.sub(lambda m: "| " + " | ".join(c.strip() for c in m[0].rstrip().rstrip("\\").split("&")) + " |", text)
    return re.sub("\0m(\\d+)\0", lambda m: held[int(m[1])], text)


def _wiki(text: str) -> str:
    def rows(m: re.Match[str]) -> str:
        out, cells = [], []
        for line in m[1].split("\n")[1:]:
            line = line.strip()
            if line.startswith("|-"):
                out.append(cells)
                cells = []
            elif line.startswith("!"):
                cells += [c.strip() for c in line[1:].split("!!")]
            elif line.startswith("|"):
                cells += [c.strip() for c in line[1:].split("||")]
        out = [r for r in [*out, cells] if r]
        return "".join(f"| {' | '.join(r)} |\n" + ("|" + "---|" * len(r) + "\n" if not i else "") for i, r in enumerate(out))

    text = re.sub(r"^(\{\|.*?)^\|\}[ \t]*\n?", rows, text, flags=re.M | re.S)
    text = re.sub(r"\[\[(?:File|Image|Datei|Fichier|文件):[^\[\]\n]*\]\]\n?", "", text, flags=re.I)
    text = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]", r"\1", text)
    text = re.sub(r"[ \t]?\{\{[^{}\n]*\}\}", "", text)
    text = re.sub(r"'''([^'\n]+)'''", r"\1", text)
    text = re.sub(r"(?<![\d'])''(?=[^\s'])([^'\n]+)''(?!')", r"\1", text)
    text = re.sub(r"^(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", lambda m: "#" * len(m[1]) + " " + m[2], text, flags=re.M)
    return re.sub(r"^(\*{2,})[ \t]+(?=\S)", lambda m: "  " * (len(m[1]) - 1) + "- ", text, flags=re.M)


def clean(text: str | None) -> str | None:
    """The text without markup; see the module's text."""
    return read(text)[1]


def read(text: str | None) -> tuple[set[str], str | None]:
    """(kinds of markup, the text without it)."""
    if not text or not any(x in text for x in _SIGNS):
        return set(), text
    source = text.replace("\r\n", "\n")
    held: list[str] = []

    def hold(m: re.Match[str]) -> str:
        held.append(m[0])
        # as many lines as before, so that lines keep their numbers
        return f"\0c{len(held) - 1}\0" + "\n" * m[0].count("\n")

    new = CODE.sub(hold, source)
    stream = Stream(new)
    of = stream.kinds
    if not of:
        return of, text
    if drop := stream.outside():
        new = "\n".join(x for i, x in enumerate(new.split("\n"), 1) if i not in drop)
    if "latex" in of:
        new = _latex(new)
    if "wiki" in of:
        new = _wiki(new)
    if "html" in of:
        new = _unshielded("".join(stream.html.out)) if of == {"html"} and not drop else _html(new)
        if "wiki" in Stream(new).kinds:  # markup that was written with entities
            new = _wiki(new)
        if any(m[1].lower() in ELEMENTS for m in TAG.finditer(new)):
            new = _html(new)
    new = re.sub("\0c(\\d+)\0(\n*)", lambda m: held[int(m[1])] + m[2][held[int(m[1])].count("\n") :], re.sub(r"[ \t]+\n", "\n", new))
    return of, re.sub(r"\n{3,}", "\n\n", new).strip("\n") if not held else _squeezed(new).strip("\n")


def _squeezed(text: str) -> str:
    """Without more than one blank line at a place, but in code."""
    out, at = [], 0
    for m in CODE.finditer(text):
        out += [re.sub(r"\n{3,}", "\n\n", text[at : m.start()]), m[0]]
        at = m.end()
    return "".join(out) + re.sub(r"\n{3,}", "\n\n", text[at:])


def clean_column(df: DataFrame, text: str, *keys: str, only_marked: bool = False) -> DataFrame:
    """keys, markup (its kinds, sorted, joined by a comma) and cleaned. only_marked: without the rows that hold none."""

    def make():
        def batch(c: dict[str, list]) -> dict[str, list]:
            got = [read(x) for x in c["__text"]]
            take = [i for i, (k, _) in enumerate(got) if k or not only_marked]
            return {k: [c[k][i] for i in take] for k in keys} | {"markup": [",".join(sorted(got[i][0])) for i in take], "cleaned": [got[i][1] for i in take]}

        return batch

    kinds_ = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return through(df.selectExpr(*[f"`{k}`" for k in keys], f"`{text}` AS __text"), make, f"{kinds_}, markup string, cleaned string")


def p6_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies and chunks with markup, and the text they become."""
    return clean_column(texts(spark, folder, documents="content_md", chunks="content"), "content", "item_kind", "item_key", only_marked=True)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Of the same operator; a row delivered again gives the key once."""
    return p6_cleaned(spark, folder).select("item_kind", "item_key").distinct()
