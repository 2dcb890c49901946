"""Text values that lost their end: near copies that go on, and closing words that close nothing."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.canon import canonical
from newsloom.runtime import pin, pin_table

_COUNTERS = re.compile(r"\s*\|\s*\w+=\d+(?:\s*;\s*\w+=\d+)*\s*$")
# What is put where a text was broken off.
_DOTS = r"(?:\.\.\.|…|\[\.\.\.\]|\[…\]|\(\.\.\.\)|\(…\))"
_INVITATION = r"(?:Read more|READ MORE|Read the full (?:story|article)|Continue reading|Weiterlesen|Mehr lesen|Leer más|Seguir leyendo|Lire la suite|Читать далее|阅读全文|查看全文|展开全文)"
_MARK = re.compile(rf"\s*(?:{_DOTS}?\s*[(\[]?{_INVITATION}[)\]]?|{_DOTS}\s*\(?more\)?|[(\[]more[)\]]|{_DOTS})$")
_ENTITY = re.compile(r"&(?:#\d{0,7}|#x[0-9a-f]{0,6}|[a-z]{1,7}\d{0,2})?$", re.I)
_CLOSED = re.compile(r"[.!?。！？…][\"'”’»）)\]」』]*$|[\"”’»）)\]」』]$")
_OPEN_END = re.compile(r"[,;:\-–—(\[«“„、，；：/&]$")
_NUMBER_END = re.compile(r"\d[.,]?$")
_SENTENCE_INSIDE = re.compile(r"[.!?]['\"”»)]?\s+\S|[。！？]\S")
_TOKEN = re.compile(r"[一-鿿]|\d+(?:[.,]\d+)*|[^\W\d_一-鿿]+(?:['’][^\W\d_]+)?")
_ATTRIBUTED = re.compile(r"\s[-–—|]\s[^-–—|.]{2,40}$")
_SEPARATE = re.compile(r"^\s*(?:[-–—|?!:(\[]|$)")
_CJK = re.compile(r"[一-鿿]")


@dataclass(frozen=True)
class Closing:
    """How near copies are found and closing words are judged.

    A cut copy holds only the beginning of its text, so the min-hashes are taken over the five-word
    shingles of the first `first`, 2 `first`, 4 `first` ... words, as long as the value has so many: a copy
    cut at any length shares its longest level with the whole text. `bands` bands of `width` minima each find
    a beginning of similarity 0.8 with odds of 1 - (1 - 0.8^width)^bands, 0.998 by default; pairs are
    verified by the share of the cut copy's shingles that stand in the other. Values of lists of over
    `long_list` are paired only where the last words of one stand in the other, as all pairs that align do;
    so the limit changes the work and no verdict.

    A word that ends fewer than `rare` of the values it stands in closes nothing, one that ends `closer`
    of them or more, `seen` times at least, is a closing word. `marks` False judges values with a mark by
    the text before it, to measure what the rest of the method finds.
    """

    shingle: int = 5
    similarity: float = 0.8
    first: int = 6
    width: int = 2
    bands: int = 6
    long_list: int = 64
    rare: float = 0.02
    seen: int = 10
    support: int = 20
    closer: float = 0.2
    marks: bool = True
    seed: int = 7


def strip_counters(text: str) -> str:
    """The text without counters a listing put after it."""
    return _COUNTERS.sub("", text).rstrip() if "|" in text and "=" in text else text.rstrip()


def bare(text: str) -> str:
    """The text before the mark that stands for its missing rest."""
    m = _MARK.search(text[-48:])
    return text[: max(0, len(text) - 48) + m.start()] if m else text


def form(text: str) -> tuple[str, str]:
    """('marked' | 'broken' | 'closed' | 'open', closing token) of a value by its last characters.

    marked: something stands for the missing rest. broken: the last character cannot end a text (half an
    entity or character, a comma). closed: it ends like a sentence, a quotation, a bracket or with a name set off by a dash. open: it
    ends in a word or number, which the corpus must judge.
    """
    t = text
    if not t:
        return "closed", ""
    end = t[-48:]  # every pattern below speaks of the last characters
    if t.endswith("�") or "&" in end and _ENTITY.search(end):
        return "broken", ""
    if _MARK.search(end):
        return "marked", ""
    if _OPEN_END.search(t[-1:]):
        return "broken", ""
    if _CLOSED.search(t[-8:]) and not _NUMBER_END.search(t[-3:]) or " " in end and _ATTRIBUTED.search(end):
        return "closed", ""
    tokens = _TOKEN.findall(t[-80:])
    if not tokens:
        return "closed", ""
    return "open", _closing(tokens)


def _closing(tokens: list[str]) -> str:
    last = tokens[-1]
    if last[0].isdigit():
        return "0"
    if _CJK.match(last):
        return "".join(x for x in tokens[-2:] if _CJK.match(x))
    return last.lower()


def _units(tokens: list[str]) -> Iterator[str]:
    """The tokens in the form `_closing` gives: numbers as one, ideographs in pairs."""
    before = ""
    for x in tokens:
        if x[0].isdigit():
            yield "0"
            before = ""
        elif _CJK.match(x):
            if before:
                yield before + x
            before = x
        else:
            yield x
            before = ""


def _read(c: Closing):
    """One pass over the texts: a row per value with its form and band keys, and rows of word counts (v null).

    A word stands inside values, or closes one that carries no mark; a sentence's last word closes too.
    """
    rng = np.random.default_rng(c.seed)
    mul = (rng.integers(1, 2**32, c.width * c.bands, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
    add = rng.integers(0, 2**32, c.width * c.bands, dtype=np.uint64).astype(np.uint32)[:, None]
    band = np.arange(1, c.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    none = np.empty(0, np.int64)

    def keys_of(tokens: list[str]) -> np.ndarray:
        n = len(tokens)
        if n < c.first:
            return none
        hashes = np.fromiter((crc32(" ".join(tokens[i : i + c.shingle]).encode("utf-8", "replace")) for i in range(n - c.shingle + 1)), np.uint32, n - c.shingle + 1)
        least = np.minimum.accumulate(hashes[None, :] * mul + add, axis=1)
        length, out = c.first, []
        while length <= n:
            head = least[:, length - c.shingle].reshape(c.bands, c.width).astype(np.uint64)
            v = band * np.uint64(length)
            for j in range(c.width):
                v = (v ^ head[:, j]) * np.uint64(0xFF51AFD7ED558CCD)
                v ^= v >> np.uint64(33)
            out.append(v)
            length *= 2
        return np.concatenate(out).view(np.int64)

    def ending(tokens: list[str]) -> int:
        return crc32(" ".join(tokens[-5:]).encode("utf-8", "replace"))

    def rows(v, text, kind, word, several, keys, ends, inside, final):
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate([*keys, none])))
        return pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int64()), pa.array(text, pa.string()), pa.array(kind, pa.string()), pa.array(word, pa.string()), pa.array(several, pa.bool_()), lists, pa.array(ends, pa.int64()), pa.array(inside, pa.int64()), pa.array(final, pa.int64())],
            names=["v", "text", "kind", "word", "several", "keys", "ends", "inside", "final"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter = Counter()
        final: Counter = Counter()

        def counts():
            words = list(inside.keys() | final.keys())
            n = len(words)
            out = rows([None] * n, [None] * n, [None] * n, words, [None] * n, [none] * n, [None] * n, [inside[w] for w in words], [final[w] for w in words])
            inside.clear()
            final.clear()
            return out

        for batch in batches:
            texts = [strip_counters(t) for t in batch.column(1).to_pylist()]
            forms, keys, ends = [], [], []
            for i, t in enumerate(texts):
                kind, word = form(t)
                if kind == "marked":
                    t = bare(t)
                    if not c.marks:
                        texts[i] = t
                        kind, word = form(t)
                forms.append((kind, word))
                tokens = _TOKEN.findall(t.lower())
                keys.append(keys_of(tokens))
                ends.append(ending(tokens))
                if tokens:
                    units = list(_units(tokens))
                    inside.update(units[:-1])
                    if kind == "open":
                        final[word] += 1
                    elif kind == "closed" and t[-1] in ".。!?！？":
                        final[units[-1]] += 1
            n = len(texts)
            yield rows(batch.column(0).to_pylist(), texts, [f[0] for f in forms], [f[1] for f in forms], [bool(_SENTENCE_INSIDE.search(t)) for t in texts], keys, ends, [None] * n, [None] * n)
            if len(inside) > 200_000:
                yield counts()
        yield counts()

    return run


_READ = "v bigint, text string, kind string, word string, several boolean, keys array<bigint>, ends bigint, inside bigint, final bigint"


_NEAR = "v bigint, w bigint, key bigint, ask boolean"


def _pair_lists(limit: int):
    """Pairs (v, w) of the values of each list (key, v, e) in key order: v may be cut and w ends otherwise.

    The low bit of e tells whether a value may be cut, the others its ending. Values of lists over `limit`
    are handed on with their key. At most `limit` values and a batch are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        long_ = False

        def give(cols, final):
            nonlocal held, long_
            key, v, e = cols
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            begin, end = edge[:-1].copy(), edge[1:].copy()
            many = end - begin > limit
            many[0] |= long_
            held, long_ = None, False
            if not final:
                if many[-1]:
                    held, long_ = [c[end[-1] - 1 :] for c in cols], True  # one row tells the next batch
                    end[-1] -= 1
                else:
                    held = [c[begin[-1] :] for c in cols]
                    begin, end, many = begin[:-1], end[:-1], many[:-1]
            out = [(v[b:e_], key[b:e_], (e[b:e_] & 1) == 1) for b, e_ in zip(begin[many], end[many])]
            begin, end = begin[~many], end[~many]
            size = end - begin
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for k in np.unique(size[size > 1]):
                at = begin[size == k]
                for d in range(1, k):
                    x = (at[:, None] + np.arange(k - d)[None, :]).ravel()
                    differ = (e[x] >> 1) != (e[x + d] >> 1)
                    one, other = differ & ((e[x] & 1) == 1), differ & ((e[x + d] & 1) == 1)
                    left += [v[x[one]], v[x[other] + d]]
                    right += [v[x[one] + d], v[x[other]]]
            pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
            n, m = pairs.shape[1], sum(len(o[0]) for o in out)
            if n + m:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([pairs[0], *(o[0] for o in out)])),
                        pa.concat_arrays([pa.array(pairs[1]), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(np.concatenate([np.empty(0, np.int64), *(o[1] for o in out)]))]),
                        pa.concat_arrays([pa.nulls(n, pa.bool_()), pa.array(np.concatenate([np.empty(0, bool), *(o[2] for o in out)]))]),
                    ],
                    names=["v", "w", "key", "ask"],
                )

        for batch in batches:
            if batch.num_rows:
                cols = [batch.column(i).to_numpy() for i in range(3)]
                if held is not None:
                    cols = [np.concatenate(c) for c in zip(held, cols)]
                yield from give(cols, False)
        if held is not None:
            yield from give(held, True)

    return run


def _tails(reach: int):
    """Of the values (key, v, ask, text, ends) of long lists: each run of `reach` words with the word after it, and what the value asks for.

    Rows (key, h, word, v, ends, ask): a run stands in v where `ask` is false; where it is true, the last
    `reach` whole words of v, without a mark, have the hash h and `word` ends it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed(words):
            return crc32(" ".join(words).encode("utf-8", "replace"))

        for batch in batches:
            out = set()
            for key, v, ask, text, ends in zip(*(batch.column(i).to_pylist() for i in range(5))):
                words = [w.lower() for w in _TOKEN.findall(text)]
                out.update((key, hashed(words[i : i + reach]), words[i + reach], v, ends, False) for i in range(len(words) - reach))
                tail, last = _tail(bare(text), reach) if ask else ((), "")
                if tail:
                    out.add((key, hashed(tail), last, v, ends, True))
            cols = list(zip(*out)) if out else [()] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(cols, types)], names=["key", "h", "word", "v", "ends", "ask"])

    return run


@lru_cache(maxsize=8192)
def _tail(text: str, reach: int) -> tuple[tuple[str, ...], str]:
    words = [w.lower() for w in _TOKEN.findall(text)]
    return (tuple(words[-1 - reach : -1]), words[-1]) if len(words) > reach else ((), "")


@lru_cache(maxsize=8192)
def _shingles(text: str, k: int) -> tuple[frozenset, frozenset]:
    """The runs of k words of a text, and those without its last word, which may be half a word."""
    words = [w.lower() for w in _TOKEN.findall(text)]
    runs = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    return frozenset(runs), frozenset(runs[:-1])


def near_copy(short: str, long: str, c: Closing) -> bool:
    """Whether enough of the first text's shingles stand in the second; a text of one shingle is compared without it."""
    own = _shingles(short, c.shingle)[1]
    return len(own & _shingles(long, c.shingle)[0]) >= c.similarity * len(own)


def ends_early(short: str, long: str, reach: int = 4) -> str:
    """How `short` ends against a near copy: 'word' inside one of its words, 'text' between two, 'same', '' if it does not align.

    The last `reach` whole words of `short` must stand in `long` in that order; what follows there decides.
    A tail that a separator sets off (a source's name, a question mark) is no continuation.
    """
    tail, last = _tail(short, reach)
    bare = long.lower()
    if not tail or not all(w in bare for w in tail):
        return ""
    t = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(long)]
    low = [x[0].lower() for x in t]
    for i in range(len(low) - reach - 1, -1, -1):
        if tuple(low[i : i + reach]) == tail and low[i + reach].startswith(last):
            word, _, end = t[i + reach]
            if len(word) > len(last):
                return "word"
            return "same" if _SEPARATE.match(long[end:]) or long[end : end + 1] in ".,;。，" else "text"
    return ""


def _align(c: Closing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vs, how = [], []
            for v, x, y in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x = bare(x)
                h = ends_early(x, y)
                if h and near_copy(x, y, c):
                    vs.append(v)
                    how.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(vs, pa.int64()), pa.array(how, pa.string())], names=["v", "how"])

    return run


def _alignments(judged: DataFrame, c: Closing, reach: int = 4) -> DataFrame:
    """(v, how): how each value that may be cut ends against its near copies, over all of them."""
    may = F.col("kind") != "closed"
    post = judged.select(F.explode("keys").alias("key"), "v", F.shiftleft("ends", 1).bitwiseOR(may.cast("bigint")).alias("e"))
    near = pin_table(post.repartition("key").sortWithinPartitions("key").mapInArrow(_pair_lists(c.long_list), _NEAR))
    texts = judged.select("v", "text")
    runs = near.filter("w is null").select("key", "v", "ask").join(judged.select("v", "text", "ends"), "v").select("key", "v", "ask", "text", "ends")
    runs = pin_table(runs.mapInArrow(_tails(reach), "key bigint, h bigint, word string, v bigint, ends bigint, ask boolean"))
    has = runs.filter("not ask").select("key", "h", F.col("word").alias("other"), F.col("v").alias("w"), F.col("ends").alias("end"))
    met = runs.filter("ask").join(has, ["key", "h"]).filter(F.startswith("other", "word") & (F.col("ends") != F.col("end"))).select("v", "w")
    pairs = near.filter("w is not null").select("v", "w").union(met).distinct()
    pairs = pairs.join(texts, "v").join(texts.select(F.col("v").alias("w"), F.col("text").alias("other")), "w").select("v", "text", "other")
    return pairs.mapInArrow(_align(c), "v bigint, how string")


def cut_values(items: DataFrame, id_col: str, columns: list[str], c: Closing = Closing()) -> DataFrame:
    """(id, field_name, why) of the values whose text was broken off.

    Method. Near copies are found by min-hash bands among all values, verified and aligned: every value
    that does not end like a sentence is aligned with all its near copies. One whose alignment ends
    inside a word of a copy ('word'), or between two words of it ('text'), ends early. Unless its closing
    word is known to close others it is cut. Values without such a copy are scored by their ending. A mark
    for the missing rest, or a last character that cannot end a text, shows a cut; the others end in a
    word: a fragment that only begins known words, or a word that stands inside values at least `seen`
    times but ends fewer than `rare` of them, closes nothing. A headline-like value whose closing word does
    close others is whole; a value of several sentences that ends in a word is cut.

    The word counts and the bands cover all values of all columns. Null and '' give no row; equal values
    are judged once and every row gets the verdict; very long values are read whole; an empty table gives
    no rows; other columns are ignored. The value of a hot group of equal texts is one node, and long
    lists of different ones are paired by their last words.
    """
    cells = items.select(F.col(id_col).alias("id"), F.explode(F.array(*[F.struct(F.lit(x).alias("field_name"), F.col(x).alias("raw")) for x in columns])).alias("c"))
    cells = cells.select("id", "c.field_name", "c.raw").filter("raw <> ''").select("id", "field_name", canonical(F.col("raw")).alias("text"))
    rows = pin_table(cells.select("id", "field_name", F.xxhash64("text").alias("v"), "text"))
    texts = rows.groupBy("v").agg(F.first("text").alias("text"))
    read = pin_table(texts.mapInArrow(_read(c), _READ))
    judged = read.filter("v is not null")
    counts = pin(read.filter("v is null").groupBy("word").agg(F.sum("inside").alias("inside"), F.sum("final").alias("final")))
    open_ = judged.filter("kind = 'open'")
    closing = open_.select("word").distinct()
    begun = counts.filter((F.col("inside") + F.col("final") >= c.support) & (F.length("word") > 2) & ~F.col("word").rlike("[一-鿿0-9]"))
    begun = begun.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda n: F.substring("word", F.lit(1), n))).alias("word"), (F.col("inside") + F.col("final")).alias("n"))
    begun = begun.groupBy("word").agg(F.max("n").alias("longer"))
    stat = closing.join(counts, "word", "left").join(begun, "word", "left").na.fill(0, ["inside", "final", "longer"])
    total = F.col("inside") + F.col("final")
    stat = stat.select(
        "word",
        (F.col("final") < c.rare * total).alias("rare"),
        ((F.col("inside") >= c.seen) & (F.col("final") < c.rare * total)).alias("never"),
        ((F.col("final") >= c.seen) & (F.col("final") >= c.closer * total)).alias("closes"),
        ((F.col("longer") >= c.support) & (F.col("longer") >= 10 * total) & (F.col("inside") * 10 <= F.col("longer")) & (F.col("final") * 20 <= F.col("longer"))).alias("fragment"),
    )
    scored = open_.select("v", "word", "several").join(stat, "word")
    aligned = _alignments(judged, c).groupBy("v").agg(F.max(F.col("how") == "word").alias("word_cut"), F.max(F.col("how") == "text").alias("text_cut"))
    scored = scored.join(aligned, "v", "left")
    why = (
        F.when(F.col("word_cut") & ~F.col("closes"), "copy goes on inside the word")
        .when(F.col("text_cut") & F.col("rare"), "copy goes on")
        .when(F.col("fragment"), "fragment of a word")
        .when(F.col("never"), "closing word never closes")
        .when(F.col("several"), "last sentence not closed")
    )
    shown = judged.filter("kind in ('marked', 'broken')").select("v", "kind").join(aligned, "v", "left")
    shown = shown.select("v", F.when(F.col("word_cut") | F.col("text_cut"), "copy goes on").otherwise(F.col("kind")).alias("why"))
    verdict = scored.select("v", why.alias("why")).filter("why is not null").union(shown)
    return rows.select("id", "field_name", "v").join(verdict, "v").select(F.col("id").alias(id_col), "field_name", "why")


def cut_rates(items: DataFrame, cuts: DataFrame, id_col: str, source_col: str, columns: list[str]) -> DataFrame:
    """(source, field_name, n_values, n_cut, share) for every source and column; null sources form one group."""
    cells = items.select(F.col(source_col).alias(source_col), F.col(id_col), F.explode(F.array(*[F.struct(F.lit(x).alias("field_name"), F.col(x).alias("raw")) for x in columns])).alias("c"))
    cells = cells.select(source_col, id_col, "c.field_name", "c.raw").filter("raw <> ''")
    marked = cells.join(cuts.select(id_col, "field_name", F.lit(1).alias("cut")).distinct(), [id_col, "field_name"], "left")
    return marked.groupBy(source_col, "field_name").agg(F.count("*").alias("n_values"), F.sum(F.coalesce("cut", F.lit(0))).alias("n_cut")).withColumn("share", F.col("n_cut") / F.col("n_values"))
