"""Problem 3: noise of scanned pages, repaired to continuous paragraphs.

First the page's furniture goes: page numbers, page markers, and running headers, which repeat the document's title or
institution. Then lines that the page's width broke are joined, words hyphenated across lines with or without their
hyphen, whichever form the corpus knows better, and spaced-out words closed. Last, characters are corrected by a noisy
channel: each word has candidates, which are all words of the corpus' lexicon that confusions of scanners can have turned
into it; the probability of each confusion is estimated from the corpus by expectation-maximization; that of a word after
the word before it comes from counts over the whole corpus; the best path through each line's candidates is found by
Viterbi. Chinese is decoded the same way over characters.

Candidates are found by walking the lexicon and the token at once, so that neither length nor number of confusions is
limited. A noisy form is itself a word of the corpus: what misreading of its candidates already explains doesn't count for
it, and a candidate is only taken that is RATIO times as frequent. Rates and ratios decide, whatever the size of the corpus.

Defined results: null stays null; empty texts and texts without noise come out as they are, with zero edits; code, tables,
headings and markup lines are left alone; line ends CRLF are read as LF, which alone is no edit. Texts are taken whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.arrow import through
from tessella.llm.chars import PairModel, codes, pair_model
from tessella.llm.counts import Counts, hash64
from tessella.session import cut
from tessella.sources.tables import spread, table

#: Words and word pairs with this share of all words or less count as unseen; so at most 1 / RATE of each are collected and broadcast.
RATE = 1e-7
RATIO = 20.0
#: Confusions of scanners, misread -> true.
CONFUSIONS = {"c": ("e",), "!": ("i", "l"), "@": ("a",), "0": ("o",), "5": ("s",), "|": ("l", "i"), "1": ("l", "i"), "cl": ("d",), "9": ("g",), "li": ("h",), "u": ("ti",), "rn": ("m",), "m": ("in", "rn"), "h": ("li",), "vv": ("w",), "^": ("",), "~": ("",), "■": ("",), "•": ("",), "¬": ("",), "\xad": ("",), "$": ("s",), "6": ("b",), "8": ("b",), "ii": ("n",), "nn": ("m",), "tl": ("d",)}
HAN = {"ꎬ": "，", "ꎮ": "。", "旳": "的", "耆": "者", "里": "量", "惠": "患", "荆": "剂", "曰": "日", "冶": "治", "庁": "疗", "夭": "天", "侧": "测", "義": "议", "捡": "检", "入": "人", "太": "大", "未": "末", "己": "已", "土": "士", "干": "千", "问": "间"}
#: What a confusion's log probability is before any text is read, how many occurrences that weighs, the least it can be, and rounds of estimation.
SHARE, WEIGHT, LEAST, ROUNDS = -6.0, 10_000.0, -14.0, 2
#: Log probabilities that a word is none of the lexicon, and of each of its letters.
NEW, LETTER = math.log(0.01), math.log(1 / 27)
_BY_FIRST: dict[str, list[tuple[str, str]]] = defaultdict(list)
for _bad, _goods in CONFUSIONS.items():
    _BY_FIRST[_bad[0]] += [(_bad, g) for g in _goods]
_SIGNS = frozenset("".join(b for b in CONFUSIONS if not b.isalpha()))
_JOINT = "-'’‐‑·."
_MISREAD = re.compile("[" + "".join(HAN) + "]+")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\s　-〿＀-￯㐀-鿿ꎬꎮ()\[\]{}<>“”„«»\"/;:,…≤≥=+×±–—]+")
_SIGNED = re.compile(r"[^\s　-〿＀-￯㐀-鿿()\[\]{}<>“”„«»\"/;:,…≤≥=+×±–—]+")
_PLAIN = re.compile(r"[^\W\d_]+(?:[-'’‐‑·.][^\W\d_]+)*")
_TRIM = ".?'’‘*_`%-‐"
_HAN = re.compile(r"[㐀-鿿]")

_PAGE = re.compile(
    r"^\s*(?:(?:page|seite|pag\.?|p\.|s\.)\s*\d{1,4}(?:\s*(?:of|von|sur|de|/)\s*\d{1,4})?|第\s*\d{1,4}\s*页(?:[\s，,]*共\s*\d{1,4}\s*页)?|[-–—·•*~]+\s*\d{1,4}\s*[-–—·•*~]+|\d{1,4}\s*/\s*\d{1,4}|\[\s*\d{1,4}\s*\]|\d{1,4}|<!--\s*page:\s*\d+\s*-->)\s*$",
    re.I,
)
_NUMBERS = " \t\r\u3000\xa00123456789|·–—-"
_STRUCTURE = re.compile(r"\s*(?:#|\||[-*+•]\s|\d{1,3}[.)]\s|>|```|~~~|<|\\|\$|\{\||!|==|&)")
_TAIL = re.compile(r"\\\\\s*$|</?\w+[^>]*>\s*$|\\\]\s*$|\|\s*$")
_ENDS = ("\\", ">", "]", "|")
_LEAD = re.compile(r"^\s*(?:[-*+•>]\s|\d{1,3}[.)]\s)")
_CLOSED = re.compile(r"[.!?。！？:：;；…ꎮ](?:[\"'”’)）\]*_]|\s|</?\w+[^>]*>|\{\{[^}]*\}\})*$")
_HYPHEN = re.compile(r"([^\W\d_]+)[-‐‑¬\xad]$")
_SPACED = re.compile(r"(?<![^\s(\[“„«\"'’])(?:[^\W\d_㐀-鿿] ){3,}[^\W\d_㐀-鿿](?![^\W_]|�)")
_HAN_SPACE = re.compile(r"(?<=[㐀-鿿，。ꎬꎮ、；：）]) +(?=[㐀-鿿（])|(?<=[㐀-鿿]) +(?=[，。ꎬꎮ、；：）])")
_MAYBE_SPACED = re.compile(r" [^\W\d_] [^\W\d_] ")
_MARKUP = re.compile(r"<[A-Za-z/!][^>]*>|\\[A-Za-z]+|\{\{|\[\[|&#?\w+;|[�]")


def _structural(line: str) -> bool:
    return bool(_STRUCTURE.match(line)) or line.rstrip().endswith(_ENDS) and bool(_TAIL.search(line))


@dataclass
class WordModel:
    """The lexicon with its counts, counts of word pairs, and the log probability of each confusion."""

    lexicon: dict[str, float]
    pairs: Counts
    total: float
    shares: dict[tuple[str, str], float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.words = sorted(self.lexicon)
        self.most = max(self.lexicon.values(), default=0.0)
        self.rare = max(1.0, RATE * self.total)  # no word outside the lexicon counts more
        self.known: dict[tuple[str, str], float] = {}

    def count(self, w: str) -> float:
        return self.lexicon.get(w, 0.0)

    def pair(self, a: str, b: str) -> float:
        if (n := self.known.get((a, b))) is None:
            n = self.pairs.one(hash64(f"{a} {b}"))
            if len(self.known) < 1 << 18:
                self.known[a, b] = n
        return n

    def begins(self, prefix: str) -> bool:
        i = bisect_left(self.words, prefix)
        return i < len(self.words) and self.words[i].startswith(prefix)

    def share(self, bad: str, good: str) -> float:
        return self.shares.get((bad, good), SHARE)

    def readings(self, token: str, own: float) -> dict[str, tuple[float, tuple[tuple[str, str], ...]]]:
        """What a lower-case token can have been: its parts are letters, and each that changes is a word RATIO times as frequent as
        the token. With the log probability of the confusions, and which they are; of several ways the likeliest."""
        need = RATIO * max(1.0, own)
        out: dict[str, tuple[float, tuple[tuple[str, str], ...]]] = {}
        # at, finished parts, the open part, whether it has changed, longest part, log probability, confusions
        stack: list[tuple[int, str, str, bool, int, float, tuple[tuple[str, str], ...]]] = [(0, "", "", False, 0, 0.0, ())]
        n = len(token)

        def closes(part: str, changed: bool) -> bool:
            return bool(part) and (not changed or self.count(part) >= need)

        while stack:
            i, done, part, changed, longest, p, used = stack.pop()
            if i == n:
                if used and closes(part, changed) and max(longest, len(part)) >= 3 and (done + part not in out or out[done + part][0] < p):
                    out[done + part] = (p, used)
                continue
            c = token[i]
            if c.isalpha():
                if not changed or self.begins(part + c):
                    stack.append((i + 1, done, part + c, changed, longest, p, used))
            elif c in _JOINT and closes(part, changed):
                stack.append((i + 1, done + part + c, "", False, max(longest, len(part)), p, used))
            for bad, good in _BY_FIRST.get(c, ()):
                if token.startswith(bad, i) and self.begins(part + good):
                    stack.append((i + len(bad), done, part + good, True, longest, p + self.share(bad, good), (*used, (bad, good))))
        return out


def word_model(df: DataFrame, *columns: str) -> WordModel:
    """Counted over all rows of the columns: each task sums words, pairs and tokens with signs before they are shuffled. From the
    words and tokens that have readings, each confusion's probability is then estimated."""

    def count(batches):
        words, pairs, tokens = Counter(), Counter(), Counter()

        def rows():
            for w in [w for w in pairs if not (w[0] and w[1])]:
                del pairs[w]
            kind = np.repeat(np.array([0, 1, 2], np.int8), [len(tokens), len(words), len(pairs)])
            text = pa.array([*tokens, *words, *([None] * len(pairs))], pa.string())
            key = np.array([0] * (len(tokens) + len(words)) + [hash64(" ".join(w)) for w in pairs], np.uint64)
            n = np.array([*tokens.values(), *words.values(), *pairs.values()], np.int64)
            for x in (words, pairs, tokens):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(kind), text, pa.array(key.view(np.int64)), pa.array(n)], ["kind", "word", "key", "n"])

        for b in batches:
            for col in b.columns:
                for x in col.to_pylist():
                    if x:
                        low = x.lower()
                        ws = ["" if "㐀" <= w[0] <= "鿿" else w for w in _WORD.findall(low)]  # Chinese runs are decoded by characters
                        words.update(ws)
                        pairs.update(zip(ws, ws[1:]))
                        if any(c in low for c in _SIGNS):
                            tokens.update(t for t in _SIGNED.findall(low) if not _SIGNS.isdisjoint(t) and any(c.isalpha() for c in t))
                if len(words) + len(pairs) + len(tokens) > 400_000:
                    yield rows()
        yield rows()

    counts = cut(df.select(*columns).mapInArrow(count, "kind tinyint, word string, key bigint, n bigint").groupBy("kind", "word", "key").agg(F.sum("n").alias("n")))
    total = float(counts.filter("kind = 1").agg(F.sum("n")).first()[0] or 0)
    more = counts.filter(F.col("n") > F.lit(RATE * total))
    ws, ps = more.filter("kind = 1 AND word != ''").select("word", "n").toArrow(), more.filter("kind = 2").select("key", "n").toArrow()
    model = WordModel(dict(zip(ws.column("word").to_pylist(), map(float, ws.column("n").to_pylist()))), Counts(ps.column("key").to_numpy().view(np.uint64), ps.column("n").to_numpy()), total)
    return estimated(model, counts.filter("kind < 2 AND word != ''").select("word", "n"))


def posterior(w: str, n: float, model: WordModel) -> dict[tuple[str, str], float]:
    """How often each confusion has made this word, as far as readings explain it better than a new word does."""
    got = {y: r for y, r in model.readings(w, max(float(n), 1.0)).items()}
    out: dict[tuple[str, str], float] = {}
    if got:
        logs = [r[0] + sum(math.log((model.count(q) + 0.01) / model.total) for q in _WORD.findall(y)) for y, r in got.items()]
        logs.append(NEW + LETTER * len(w))
        most = max(logs)
        weights = [math.exp(x - most) for x in logs]
        for (_, used), v in zip(got.values(), weights):
            for u in used:
                out[u] = out.get(u, 0.0) + n * v / sum(weights)
    return out


def estimated(model: WordModel, words: DataFrame) -> WordModel:
    """The model with the probabilities of confusions. words: word, n of the whole vocabulary, which stays distributed; what comes back in
    a round is a number for each confusion."""
    sc, every = words.sparkSession.sparkContext, [(b, g) for b, gs in CONFUSIONS.items() for g in gs]
    occurs = {good: sum(n * (w.count(good) if good else len(w) + 1) for w, n in model.lexicon.items()) for _, good in every}
    for _ in range(ROUNDS):
        held = sc.broadcast((model.lexicon, model.total, model.shares))

        def expect(batches, held=held):
            lexicon, total, shares = held.value
            m = WordModel(lexicon, Counts(np.zeros(0, np.uint64), np.zeros(0)), total, shares)
            sums: dict[tuple[str, str], float] = {}
            for b in batches:
                for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if RATIO * n <= m.most and len(w) >= 3:
                        for u, v in posterior(w, n, m).items():
                            sums[u] = sums.get(u, 0.0) + v
            yield pa.RecordBatch.from_arrays([pa.array([u[0] for u in sums], pa.string()), pa.array([u[1] for u in sums], pa.string()), pa.array(list(sums.values()), pa.float64())], ["bad", "good", "n"])

        got = {(r.bad, r.good): r.n for r in words.mapInArrow(expect, "bad string, good string, n double").groupBy("bad", "good").agg(F.sum("n").alias("n")).collect()}
        held.unpersist()
        model.shares = {u: max(LEAST, math.log((got.get(u, 0.0) + WEIGHT * math.exp(SHARE)) / (occurs[u[1]] + WEIGHT))) for u in every}
    return model


def han_shares(df: DataFrame, text: str, chars: PairModel) -> dict[str, float]:
    """The log probability of each confused Chinese character: how often it stands where, between its neighbours, the true one is
    expected, against how often the true one stands. All texts are read; what comes back is two numbers for a character."""
    held = df.sparkSession.sparkContext.broadcast(chars)
    bad = np.array([ord(c) for c in HAN], np.uint32)
    good = np.array([ord(c) for c in HAN.values()], np.uint32)

    def expect(batches):
        m = held.value
        sums = np.zeros((2, len(bad)))
        order = np.argsort(bad)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                c = codes("\n" + "\n".join(b.column(0).slice(at, 256).to_pylist()) + "\n")
                k = np.minimum(np.searchsorted(bad[order], c), len(bad) - 1)
                spot = np.flatnonzero(bad[order][k] == c)
                spot = spot[(spot > 0) & (spot < len(c) - 1)]
                which = order[k[spot]]
                triple = np.stack([c[spot - 1], c[spot], c[spot + 1]], 1)
                own = m.log_codes(triple.ravel()).reshape(-1) if len(spot) else np.zeros(0)
                own = _within(own, len(spot))
                triple[:, 1] = good[which]
                other = _within(m.log_codes(triple.ravel()) if len(spot) else np.zeros(0), len(spot))
                p = 1 / (1 + np.exp(np.clip(own - other - SHARE, -50, 50)))
                sums[0] += np.bincount(which, p, len(bad))
                sums[1] += [np.count_nonzero(c == g) for g in good]
        yield pa.RecordBatch.from_arrays([pa.array(list(HAN)), pa.array(sums[0]), pa.array(sums[1])], ["bad", "n", "good"])

    some = df.filter(F.col(text).rlike("[" + "".join(HAN) + "]")).select(text)
    got = some.mapInArrow(expect, "bad string, n double, good double").groupBy("bad").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
    return {r.bad: max(LEAST, min(-0.7, math.log((r.n + WEIGHT * math.exp(SHARE)) / (r.n + r.good + WEIGHT)))) for r in got}


def _within(logs: np.ndarray, n: int) -> np.ndarray:
    """Of the logs of triples laid one after another, the sum inside each."""
    if not n:
        return np.zeros(0)
    x = np.concatenate([logs, [0.0]]).reshape(n, 3)
    return x[:, 0] + x[:, 1]


class Repair:
    """Repairs texts; see the module's text."""

    def __init__(self, words: WordModel, chars: PairModel, han: dict[str, float] | None = None):
        self.words, self.chars, self.han = words, chars, han or {}
        self.options: dict[str, list[tuple[str, float]]] = {}
        self.sure: set[str] = set()  # tokens, as they stand in lines, without another candidate
        self.genuine: dict[str, float] = {}  # counts of doubtful tokens less what misreading explains
        self.logs: dict[str, float] = {}

    # -- words

    def candidates(self, token: str) -> list[tuple[str, float]]:
        """(word, log of the channel's probability); the token as it is comes first."""
        if (known := self.options.get(token)) is not None:
            return known
        out, w = [(token, 0.0)], self.words
        low = token.lower()
        own = min((max(w.count(p), w.rare) for p in _WORD.findall(low)), default=0.0) if _PLAIN.fullmatch(low) else 0.0
        if any(c.isalpha() for c in low) and len(low) >= 3 and RATIO * own <= w.most and not _MARKUP.search(token) and not any("㐀" <= c for c in low):
            explained = 0.0
            for y, (p, _) in w.readings(low, own).items():
                out.append((self.cased(token, y), p))
                explained += min(map(w.count, _WORD.findall(y))) * math.exp(p)
            if len(out) > 1 and len(self.genuine) < 1 << 17:
                self.genuine[token] = max(0.0, w.count(low) - explained)
        if len(self.options) < 1 << 17:
            self.options[token] = out
        return out

    @staticmethod
    def cased(like: str, word: str) -> str:
        return word.upper() if like.isupper() and len(like) > 3 else word[:1].upper() + word[1:] if like[:1].isupper() else word

    def log(self, word: str, before: str) -> float:
        ps = _WORD.findall(word.lower()) or [""]
        n = all_ = self.words.count(ps[0])
        if (own := self.genuine.get(word)) is not None:
            n = min(n, own)
        out = math.log((n + 0.01) / self.words.total)
        if before:
            # of its pairs as large a share is genuine as of the word
            pair = self.words.pair(before, ps[0]) * (n / all_ if all_ else 0.0)
            out = math.log(0.3 * math.exp(out) + 0.7 * (pair / (self.words.count(before) + 1.0)) + 1e-12)
        return out + sum(math.log((self.words.count(p) + 0.01) / self.words.total) / 2 for p in ps[1:])

    def decode(self, line: str) -> tuple[str, int]:
        """Viterbi over the candidates of the line's words; lines without a doubtful word aren't touched."""
        if self.sure.issuperset(_TOKEN.findall(line)):
            return line, 0
        spans, options = [], []
        for m in _TOKEN.finditer(line):
            if m[0] in self.sure:
                a, b = m.span()
                spans.append((a, b))
                options.append([(m[0], 0.0)])
                continue
            a, b = m.span()
            while a < b and line[a] in _TRIM:
                a += 1
            while b > a and line[b - 1] in _TRIM:
                b -= 1
            if a < b:
                spans.append((a, b))
                options.append(self.candidates(line[a:b]))
            if (a == b or len(options[-1]) == 1) and len(self.sure) < 1 << 18:
                self.sure.add(m[0])
        if all(len(o) == 1 for o in options):
            return line, 0
        best: list[tuple[float, int]] = []
        table_: list[list[tuple[float, int]]] = []
        before: list[str] = [""]
        for o in options:
            row = []
            for w, p in o:
                if len(o) == 1 and len(before) == 1:
                    row.append(((best[0][0] if best else 0.0), 0))
                    continue
                tries = [((best[j][0] if best else 0.0) + self.log(w, x), j) for j, x in enumerate(before)]
                t = max(tries)
                row.append((t[0] + p, t[1]))
            best = row
            table_.append(row)
            before = [(_WORD.findall(w.lower()) or [""])[-1] for w, _ in o]
        at = max(range(len(best)), key=lambda j: best[j][0])
        chosen = []
        for row, o in zip(reversed(table_), reversed(options)):
            chosen.append(o[at][0])
            at = row[at][1]
        out, last, edits = [], 0, 0
        for (a, b), w in zip(spans, reversed(chosen)):
            out += [line[last:a], w]
            edits += w != line[a:b]
            last = b
        return "".join(out) + line[last:], edits

    # -- Chinese characters

    def decode_han(self, line: str) -> tuple[str, int]:
        """Viterbi over the characters of a line with ones that scanners misread; all others are sure, so that each run of
        doubtful ones is decoded between its neighbours."""
        out, last, edits = [], 0, 0
        for m in _MISREAD.finditer(line):
            a, b = m.span()
            options = [(c, HAN[c]) for c in m[0]] + [(line[b] if b < len(line) else "\n",) * 2]
            best, back, before = [0.0], [], (line[a - 1] if a else "\n",)
            for o in options:
                row = []
                for n, x in enumerate(o):
                    t = max((best[j] + self.log_han(y, x), j) for j, y in enumerate(before))
                    row.append((t[0] + (self.han.get(o[0], SHARE) if n and x != o[0] else 0.0), t[1]))
                best, before = [r[0] for r in row], o
                back.append(row)
            at, fixed = 0, []
            for row, o in zip(reversed(back), reversed(options)):
                fixed.append(o[at])
                at = row[at][1]
            new = "".join(reversed(fixed[1:]))
            out += [line[last:a], new]
            edits += sum(x != y for x, y in zip(new, m[0]))
            last = b
        return ("".join(out) + line[last:], edits) if edits else (line, 0)

    def log_han(self, a: str, b: str) -> float:
        if (known := self.logs.get(a + b)) is None:
            known = float(self.chars.log_codes(np.array([ord(a), ord(b)], np.uint32))[0])
            if len(self.logs) < 1 << 18:
                self.logs[a + b] = known
        return known

    # -- lines

    def furniture(self, line: str, headers: list[tuple[str, str]]) -> bool:
        """headers: each folded, and without anything but letters and digits."""
        if not line.strip():
            return False
        if _PAGE.match(line):
            return True
        if _structural(line):
            return False
        bare = line.strip(_NUMBERS).casefold()
        if len(bare) < (4 if _HAN.search(bare) else 8):
            return False
        squeezed = ""
        for h, letters in headers:
            if bare in h:
                return True
            if len(bare) > 2 * len(h) + 12:  # longer than the header, even if it is spaced out
                continue
            squeezed = squeezed or re.sub(r"[^\w]+", "", bare)
            if squeezed and squeezed in letters:
                return True
            if abs(len(squeezed) - len(h)) < 12 and any(c in line for c in "|@!^~■•0159") and re.sub(r"[^\w]+", "", self.decode(bare)[0].casefold()) == letters:
                return True
        return False

    def joined(self, a: str, b: str) -> str:
        """Two lines of one paragraph."""
        b = b.lstrip()
        a = a.rstrip()
        if (m := _HYPHEN.search(a)) and (n := re.match(r"[^\W\d_]+", b)):
            whole, left, right = (m[1] + n[0]).lower(), m[1].lower(), n[0].lower()
            compound = a[-1] in "-‐‑" and self.words.pair(left, right) > self.words.count(whole)
            return a + b if compound else a[:-1] + b
        if a and b and (_HAN.match(a[-1]) or a[-1] in "，。、；：）ꎬꎮ") and (_HAN.match(b[0]) or b[0] in "，。、；：（ꎬꎮ" or b[0].isdigit() or b[0] == "%") or a and b and a[-1].isdigit() and (_HAN.match(b[0]) or b[0].isdigit() and _HAN.search(a)):
            return a + b
        return f"{a} {b}"

    def repair(self, text: str | None, headers: list[str] = ()) -> tuple[str | None, Counter]:
        """(the repaired text, edits by kind)."""
        edits: Counter = Counter()
        if not text or not text.strip():
            return text, edits
        source = text.replace("\r\n", "\n").split("\n")
        # the body's own title is a running header as well as the one of its record
        headers = [h.casefold().strip() for h in (*headers, *(x[2:] for x in source[:3] if x.startswith("# "))) if h and len(h.strip()) >= 4]
        headers = [(h, re.sub(r"[^\w]+", "", h)) for h in dict.fromkeys(headers)]
        lines: list[str | None] = []
        fence = False
        plain: list[bool] = []
        for line in source:
            if line.lstrip().startswith(("```", "~~~")):
                fence = not fence
                lines.append(line)
                plain.append(False)
            elif fence:
                lines.append(line)
                plain.append(False)
            elif self.furniture(line, headers):
                edits["furniture"] += 1
                lines.append(None)
                plain.append(False)
            else:
                lines.append(line)
                plain.append(not _structural(line))
        out: list[str] = []
        kinds: list[bool] = []  # whether a line may be continued
        gap = furniture = False
        for line, is_plain in zip(lines, plain):
            if line is None:
                furniture = True
                continue
            if not line.strip():
                gap = True
                continue
            can = is_plain and out and kinds[-1] and not _CLOSED.search(out[-1][-120:])
            if can and (not gap or furniture):
                if not gap:
                    edits["line"] += 1
                else:
                    edits["paragraph"] += 1
                out[-1] = self.joined(out[-1], line)
            else:
                if out and gap:
                    out.append("")
                    kinds.append(False)
                out.append(line)
                kinds.append((is_plain or bool(_LEAD.match(line)) and not line.lstrip().startswith("#")) and not _MARKUP.search(line[:2]))
            gap = furniture = False
        done: list[str] = []
        fence = False
        for line in out:
            if line.lstrip().startswith(("```", "~~~")):
                fence = not fence
            if fence or not line or line.startswith("#"):
                done.append(line)
                continue
            if not line.isascii() and _HAN.search(line):
                new, n = _HAN_SPACE.subn("", line) if not line.startswith("|") else (line, 0)
                edits["spaced"] += n
                line, n = self.decode_han(new)
                edits["character"] += n
            if _MAYBE_SPACED.search(line):
                line = _SPACED.sub(lambda m: self.closed(m, edits), line)
            line, n = self.decode(line)
            edits["character"] += n
            done.append(line)
        edits = +edits
        return ("\n".join(done) if edits else text), edits

    def closed(self, m: re.Match[str], edits: Counter) -> str:
        word = m[0].replace(" ", "")
        if len(word) >= 3 and self.words.count(word.lower()) > 0:
            edits["spaced"] += 1
            return word
        return m[0]


def repair_column(df: DataFrame, text: str, keys: tuple[str, ...], headers: tuple[str, ...], words: WordModel, chars: PairModel, han: dict[str, float] | None = None, only_noisy: bool = False) -> DataFrame:
    """keys, repaired, edits (map of kind to number). headers: columns whose text a running header may repeat."""
    held = df.sparkSession.sparkContext.broadcast((words.lexicon, words.pairs, words.total, words.shares, chars, han))

    def make():
        lexicon, pairs, total, shares, chars_, han_ = held.value
        r = Repair(WordModel(lexicon, pairs, total, shares), chars_, han_)

        def batch(c: dict[str, list]) -> dict[str, list]:
            out = {k: [] for k in (*keys, "repaired", "edits")}
            for i, x in enumerate(c["__text"]):
                y, edits = r.repair(x, [c[f"__h{j}"][i] for j in range(len(headers))])
                if edits or not only_noisy:
                    for k in keys:
                        out[k].append(c[k][i])
                    out["repaired"].append(y)
                    out["edits"].append(list(edits.items()))
            return out

        return batch

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    cols = [*[F.col(k) for k in keys], F.col(text).alias("__text"), *[F.col(h).alias(f"__h{j}") for j, h in enumerate(headers)]]
    return through(df.select(*cols), make, f"{kinds}, repaired string, edits map<string,int>")


def p3_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies and sections with scan noise, and the text they become; a row delivered again comes again."""
    docs = spread(table(spark, folder, "documents", "text", "content_md"))
    words, chars = word_model(docs, "text", "content_md"), pair_model(docs, "text")
    han = han_shares(docs, "content_md", chars)
    d = table(spark, folder, "documents").selectExpr("'document' item_kind", "cast(doc_id as string) item_key", "title", "source_institution", "content_md content")
    s = table(spark, folder, "sections").selectExpr("'section' item_kind", "cast(section_id as string) item_key", "title", "source_institution", "content")
    return repair_column(spread(d).unionByName(spread(s)), "content", ("item_kind", "item_key"), ("title", "source_institution"), words, chars, han, only_noisy=True)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_repaired(spark, folder).select("item_kind", "item_key").distinct()
