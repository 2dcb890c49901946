"""Column functions over titles, summaries, addresses and bodies. All stay in the JVM unless they say otherwise."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"[\s\p{Z}]+"
CJK = r"\x{4e00}-\x{9fff}"


def squeeze(c: Column) -> Column:
    """Blank runs of any kind to one space, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def missing_as_empty(c: Column) -> Column:
    """Null and '' are both 'no value' in the data model; expressions work on ''."""
    return F.coalesce(c, F.lit(""))


def title_key(c: Column) -> Column:
    """Lower case, squeezed, characters other than a-z, 0-9, ideographs and spaces deleted."""
    return F.trim(F.regexp_replace(F.lower(squeeze(c)), rf"[^a-z0-9{CJK} ]", ""))


def plain_words(c: Column) -> Column:
    """Lower case, every run of other characters than a-z, 0-9 and ideographs replaced by one space."""
    return F.trim(F.regexp_replace(F.lower(c), rf"[^a-z0-9{CJK}]+", " "))


def word_array(c: Column, least: int = 2, stop: Sequence[str] = ()) -> Column:
    """The distinct words of `plain_words` in order, of `least` characters or more, without stop words."""
    words = F.regexp_extract_all(F.lower(c), F.lit(f"[a-z0-9{CJK}]{{{max(least, 1)},}}"), F.lit(0))
    if stop:
        words = F.filter(words, lambda w: ~w.isin(list(stop)))
    return F.array_distinct(words)


def slug(words: Column, n: int = 6, otherwise: str = "misc-event") -> Column:
    return F.when(F.size(words) > 0, F.array_join(F.slice(words, 1, n), "-")).otherwise(otherwise)


def named_words(c: Column) -> Column:
    """Words that begin with a capital or are acronyms, as written, distinct, in order; no pieces of words with other letters."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)\b([A-Z][A-Za-z0-9&.\-]+)(?![\p{L}\p{N}])"), F.lit(1)))


def has_keyword(text: Column, keyword: str) -> Column:
    """A keyword of up to three ASCII letters or digits counts as a whole word, a longer one as a substring."""
    k = keyword.lower()
    if k.isascii() and k.isalnum() and len(k) <= 3:
        return F.array_contains(F.split(F.lower(text), "[^a-z0-9]+"), k)
    return F.lower(text).contains(k)


def has_phrase(text: Column, keyword: str) -> Column:
    """A keyword with Latin letters counts at word boundaries with any blanks between its words, others as a substring."""
    import re

    if re.search("[A-Za-z]", keyword):
        pattern = r"\s+".join(re.escape(w) for w in keyword.lower().split())
        return F.lower(text).rlike(rf"\b{pattern}\b")
    return F.lower(text).contains(keyword.lower())


def keyword_hits(text: Column, keywords: Sequence[str], matcher=has_keyword) -> Column:
    """How many of the keywords a text has; a keyword listed twice counts twice."""
    total = F.lit(0)
    for k in keywords:
        total = total + matcher(text, k).cast("int")
    return total


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two word arrays; 0 where either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def overlap(a: Column, b: Column) -> Column:
    """Shared words over the smaller set; 0 where either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))).otherwise(0.0)


def contained_or_overlap(x: Column, y: Column, least: int = 3) -> Column:
    """1 where one normalised text contains the other, else shared words over the larger set."""
    p, q = plain_words(x), plain_words(y)
    a, b = word_array(x, least), word_array(y, least)
    inside = (p != "") & (q != "") & (p.contains(q) | q.contains(p))
    return F.when(inside, 1.0).when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b))).otherwise(0.0)


def matching_ratio(x: str, y: str) -> float:
    """`difflib.SequenceMatcher(None, x, y).ratio()`, several times as fast for short texts.

    The cells (i, j) with x[i] == y[j] are bits of one number, a row with a blank column for each i. Runs of
    doubled length are cells whose run goes on where its first half ends, so the longest one takes a few shifts; the
    lowest bit left is the first in x, then in y, as the matcher chooses. From 200 characters of y on, where the
    matcher leaves common characters out, it is asked itself.
    """
    if x == y:
        return 1.0  # equal texts match whole
    if len(y) >= 200:
        from difflib import SequenceMatcher

        return SequenceMatcher(None, x, y).ratio()
    size = len(y) // 8 + 1
    stride, seen = 8 * size, {}
    for j, c in enumerate(y):
        seen[c] = seen.get(c, 0) | 1 << j
    row = {c: m.to_bytes(size, "little") for c, m in seen.items()}
    blank, every = bytes(size), int.from_bytes((b"\x01" + bytes(size - 1)) * len(x), "little")
    todo, matched = [int.from_bytes(b"".join([row.get(c, blank) for c in x]), "little")], 0
    while todo:
        cells = run = todo.pop()
        if not cells:
            continue
        runs, n = [cells], 1
        while longer := run & run >> n * (stride + 1):
            run, n = longer, 2 * n
            runs.append(run)
        for i in range(len(runs) - 2, -1, -1):
            if longer := run & runs[i] >> n * (stride + 1):
                run, n = longer, n + (1 << i)
        i, j = divmod((run & -run).bit_length() - 1, stride)
        matched += n
        if i and j:
            todo.append(cells & (1 << i * stride) - 1 & ((1 << j) - 1) * every)
        todo.append(cells >> (i + n) * stride & ((1 << len(y)) - (1 << j + n)) * every)
    return 2.0 * matched / (len(x) + len(y))


@F.arrow_udf(T.DoubleType())
def sequence_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """Matching-blocks ratio of two texts (1.0 for two empty ones); Arrow batches, for pairs that survived blocking."""
    return pa.array([matching_ratio(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


@F.arrow_udf(T.StringType())
def unescape(values: pa.Array) -> pa.Array:
    """HTML entities to characters; Spark has no function for the whole entity table."""
    return pa.array([None if v is None else html.unescape(v) for v in values.to_pylist()], pa.string())


def clean_markup(c: Column) -> Column:
    """Entities decoded where there are any, tags dropped, blanks squeezed."""
    bare = F.regexp_replace(c, r"<[^<>]*>", " ")
    return squeeze(F.when(bare.contains("&"), unescape(bare)).otherwise(bare))


def page_address(c: Column) -> Column:
    """An address without query and fragment and without a slash at its end."""
    return F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), r"/+$", "")


def page_identity(c: Column) -> Column:
    """`page_address` with scheme and host in lower case."""
    bare = page_address(c)
    head = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*)", 1)
    return F.concat(F.lower(head), F.substr(bare, F.length(head) + 1))


def host(c: Column) -> Column:
    """Host of an address in lower case without www.; '' where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(missing_as_empty(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^www\.", "")


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*[F.when(c != "", c) for c in columns], F.lit(""))


def paragraphs(body: Column, least: int = 1) -> Column:
    """Lines of a body, squeezed, of at least `least` characters, without one equal to the line before it."""
    lines = F.filter(F.transform(F.split(missing_as_empty(body), "\n"), squeeze), lambda x: F.length(x) >= least)
    return F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, i - 1)))


def shorten(c: Column, n: int, mark: str = "...") -> Column:
    return F.when(F.length(c) > n, F.concat(F.rtrim(F.substring(c, 1, n)), F.lit(mark))).otherwise(c)


def mostly_english(c: Column, least: int = 8) -> Column:
    """At least `least` ASCII letters and more of them than ideographs."""
    letters = F.length(F.regexp_replace(missing_as_empty(c), "[^A-Za-z]", ""))
    return (letters >= least) & (letters > F.length(F.regexp_replace(missing_as_empty(c), f"[^{CJK}]", "")))


def plain_title(c: Column) -> Column:
    """A title for comparison: publisher after the last dash, numbering, addresses and punctuation removed."""
    x = F.regexp_replace(c, r"https?://\S+", " ")
    x = F.regexp_replace(x, r"\s+[-–—|]\s+[^-–—|]{2,40}$", "")
    x = F.regexp_replace(x, r"^\s*(?:[-*•]+|\d{1,3}[.)、])\s*", "")
    return plain_words(x)


def short_id(n: int, *columns: Column, algorithm: str = "sha1") -> Column:
    """The first n hex digits over the values joined by '|', null as ''."""
    joined = F.concat_ws("|", *[missing_as_empty(c.cast("string")) for c in columns])
    digest = {"md5": F.md5, "sha1": F.sha1, "sha256": lambda c: F.sha2(c, 256)}[algorithm](joined)
    return F.substring(digest, 1, n)


def counter_value(text: Column, name: str) -> Column:
    """The number behind `name=` in a listing's counters; null where there is none."""
    return F.regexp_extract(missing_as_empty(text), rf"\b{name}=(\d+)", 1).try_cast("long")


def steps(value: Column, bounds: Sequence[tuple[float, float]], otherwise: float) -> Column:
    """A step function: the result of the first bound the value does not exceed."""
    out = F.lit(float(otherwise))
    for limit, result in reversed(list(bounds)):
        out = F.when(value <= limit, float(result)).otherwise(out)
    return out


def repair_bytes(c: Column) -> Column:
    """Text whose UTF-8 bytes were once read as Latin-1, read again; only where it shows the signs and the bytes allow it."""
    signs = c.rlike("[ÃÂâå-é][\u0080-¿]")
    narrow = ~c.rlike("[^\u0000-ÿ]")
    again = F.try_validate_utf8(F.decode(F.encode(c, "ISO-8859-1"), "UTF-8"))
    return F.when(signs & narrow & ~again.contains("�"), again).otherwise(c)
