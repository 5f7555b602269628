"""Field values of records as columns: flags, departments, dates, ids, vectors."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.lazy import lazy_udf
from tessella.functions.text import TOKEN, _c

UNKNOWN = "unknown"
UNCLASSIFIED = "未分类"
#: Spellings of truth.
TRUE = ("1", "true", "yes", "y")


def truthy(x: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(_c(x).cast("string"))).isin(*TRUE), F.lit(False))


def split_departments(x: Column | str) -> Column:
    """A|B as an array of distinct names without empty ones."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(_c(x), F.lit("")), r"\|"), lambda f: F.trim(f)), lambda d: d != ""))


def department_text(x: Column | str) -> Column:
    return F.coalesce(F.nullif(F.array_join(split_departments(x), "|"), F.lit("")), F.lit(UNCLASSIFIED))


def department_fields(x: Column | str) -> Column:
    """(departments, primary, scope): compositive for more than one."""
    d = split_departments(x)
    return F.struct(
        F.when(F.size(d) > 0, d).otherwise(F.array(F.lit(UNCLASSIFIED))).alias("departments"),
        F.coalesce(F.try_element_at(d, F.lit(1)), F.lit(UNCLASSIFIED)).alias("department"),
        F.when(F.size(d) > 1, "compositive").otherwise("single").alias("scope"),
    )


def year(x: Column | str) -> Column:
    """The first 19xx or 20xx anywhere."""
    return F.nullif(F.regexp_extract(F.coalesce(_c(x), F.lit("")), r"(19\d{2}|20\d{2})", 1), F.lit("")).cast("int")


def valid_date(x: Column | str, first: int | None = None, last: int | None = None) -> Column:
    ok = F.coalesce(_c(x).rlike(r"^20[12]\d-\d{2}-\d{2}$"), F.lit(False))
    if first is not None and last is not None:
        ok = ok & year(x).between(first, last)
    return ok


def infer_date(path: Column | str, text: Column | str, first: int = 2012, last: int = 2026, head: int = 12000) -> Column:
    """The first year in the window in the path, else in the file's name and the head of the text; as January 1st, or unknown."""
    digits = "０１２３４５６７８９"

    def found(c: Column) -> Column:
        ys = F.transform(F.regexp_extract_all(F.translate(F.coalesce(c, F.lit("")), digits, "0123456789"), F.lit(r"(?<!\d)(20\d{2})(?!\d)"), F.lit(1)), lambda y: y.cast("int"))
        return F.try_element_at(F.filter(ys, lambda y: y.between(first, last)), F.lit(1))

    p, t = _c(path), _c(text)
    y = F.coalesce(found(p), found(F.concat_ws("\n", F.substring_index(p, "/", -1), F.substring(t, 1, head))))
    return F.coalesce(F.concat(y.cast("string"), F.lit("-01-01")), F.lit(UNKNOWN))


def recency_boost(x: Column | str) -> Column:
    y = year(x)
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(0.12), (y - 2012) / F.lit(14.0) * F.lit(0.12))), F.lit(0.0))


def time_bounds(time_range: str | dict | None) -> tuple[str | None, str | None]:
    """(start, end) of a range of years, a mapping, or a lower bound alone."""
    if not time_range:
        return None, None
    if isinstance(time_range, dict):
        return time_range.get("start") or time_range.get("start_date"), time_range.get("end") or time_range.get("end_date")
    if m := re.match(r"^\s*(\d{4})(?:-\d{2}-\d{2})?\s*[-~:]\s*(\d{4})(?:-\d{2}-\d{2})?\s*$", str(time_range)):
        return f"{m[1]}-01-01", f"{m[2]}-12-31"
    return str(time_range), None


# -- ids


def sha256_text(x: Column | str) -> Column:
    return F.sha2(F.coalesce(_c(x), F.lit("")), 256)


@lazy_udf("string")
def slug(x: pd.Series) -> pd.Series:
    """ASCII-folded words joined by _, at most 80 characters; unknown if nothing is left."""

    def one(v: str | None) -> str:
        t = "".join(c for c in unicodedata.normalize("NFKD", v or "") if not unicodedata.combining(c))
        t = re.sub(r"[^\w\s-]", "", t.strip().lower())
        return re.sub(r"[\s-]+", "_", t).strip("_")[:80] or UNKNOWN

    return x.map(one)


def doc_id(institution: Column, date: Column, digest: Column) -> Column:
    return F.concat_ws("_", slug(institution), F.coalesce(year(date).cast("string"), F.lit(UNKNOWN)), F.substring(digest, 1, 12))


def chunk_id(doc: Column | str, index: Column | str) -> Column:
    return F.format_string("%s#chunk_%05d", _c(doc), _c(index))


def short_hash(*parts: Column, length: int = 10) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, length)


def collision_suffix(base: Column, source: Column, rank: Column) -> Column:
    return F.when(rank > 1, F.concat(base, F.lit("_"), F.substring(F.sha1(source), 1, 8))).otherwise(base)


# -- vectors


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column) -> Column:
    """Of length one; the zero vector stays."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def vector_literal(a: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: F.format_string("%.8f", x.cast("double"))), ","), F.lit("]"))


def bucket(token: Column, size: int) -> Column:
    """Where a token goes in a hashed vector, from its digest."""
    return F.pmod(F.conv(F.substring(F.sha1(token), 1, 8), 16, 10).cast("bigint"), F.lit(size)).cast("int")


def sign(token: Column) -> Column:
    return F.when(F.pmod(F.conv(F.substring(F.sha1(token), 9, 2), 16, 10).cast("int"), F.lit(2)) == 0, 1.0).otherwise(-1.0)


_PLACES: dict[str, tuple[int, float]] = {}


def _place(t: str) -> tuple[int, float]:
    """The first four bytes of a token's digest, and its sign; kept for frequent tokens."""
    if (known := _PLACES.get(t)) is None:
        h = hashlib.sha1(t.encode("utf-8", "surrogatepass")).digest()
        known = int.from_bytes(h[:4], "big"), 1.0 if h[4] % 2 == 0 else -1.0
        if len(_PLACES) < 1 << 18:
            _PLACES[t] = known
    return known


_TOKEN = re.compile(TOKEN)


@lazy_udf("array<double>")
def _encode(x: pd.Series, size: pd.Series) -> pd.Series:
    return pd.Series([hash_vector(t, int(n)) for t, n in zip(x, size)])


def hashing_encoder(x: Column | str, size: int = 384) -> Column:
    """Signed feature hashing of a text's tokens, of length one. No model is needed; it runs in Arrow batches, as the map of buckets that SQL
    would need costs the square of the text's length."""
    return _encode(_c(x), F.lit(size))


def hashing_similarity(x: Column | str, query: str, size: int = 384) -> Column:
    """The cosine of a text's hashed vector and the query's, without the vector ever leaving Python."""
    q = hash_vector(query, size)

    def score(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            sums: dict[int, float] = {}
            for token in _TOKEN.findall((t or "").lower()):
                at, s = _place(token)
                sums[at % size] = sums.get(at % size, 0.0) + s
            n = math.sqrt(sum(v * v for v in sums.values()))
            out.append(sum(q[b] * v for b, v in sums.items()) / n if n else 0.0)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(score, "double")(_c(x))


def text_similarity(x: Column | str, vectors: list[list[float]]) -> Column:
    """Cosines of a text's hashed vector and each of several unit vectors, in one pass, as an array."""
    size = len(vectors[0])

    def score(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            sums: dict[int, float] = {}
            for token in _TOKEN.findall((t or "").lower()):
                at, s = _place(token)
                sums[at % size] = sums.get(at % size, 0.0) + s
            n = math.sqrt(sum(v * v for v in sums.values()))
            out.append([sum(q[b] * v for b, v in sums.items()) / n if n else 0.0 for q in vectors])
        return pd.Series(out)

    return F.pandas_udf(score, "array<double>")(_c(x))


def hash_vector(text: str, size: int = 384) -> list[float]:
    """The same of one text, for a query on the driver."""
    out = [0.0] * size
    for t in _TOKEN.findall((text or "").lower()):
        at, sign_ = _place(t)
        out[at % size] += sign_
    n = math.sqrt(sum(x * x for x in out))
    return [x / n for x in out] if n else out
