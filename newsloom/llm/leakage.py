"""Test items that stand in a training corpus, exactly or with their figures and names replaced."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from newsloom.llm.spans import _BASE, _INVERSE, _mix
from newsloom.runtime import pin_table

_WORD = re.compile(r"[^\W_]+")
_SENTENCE_END = re.compile(r"[.!?:;\"“”»。！？]\s*$")
NUMBER, NAME, UNIT = 1, 2, 3
_FIRST_WORD = 8


def _is_number(w: str) -> bool:
    return w[0].isdigit() and any(c.isdigit() for c in w)


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, capital, lower, inside, after_number) of every word of the items, once for each way it is used."""
    for batch in batches:
        rows = set()
        for text in batch.column(0).to_pylist():
            number = False
            for m in _WORD.finditer(text):
                w = m.group()
                low = w.lower()
                capital = w[0].isupper()
                inside = capital and m.start() > 0 and not _SENTENCE_END.search(text, max(0, m.start() - 4), m.start())
                rows.add((low, capital, not capital, bool(inside), not capital and number and not _is_number(low) and low.isalpha() and low.isascii()))
                number = _is_number(low)
        cols = list(zip(*rows)) if rows else [()] * 5
        types = [pa.string(), *[pa.bool_()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["word", "capital", "lower", "inside", "after_number"])


def lexicon(items: DataFrame) -> dict[str, int]:
    """The code of every word of items(text): a type for numbers, names and units, else a hash of the word.

    A name is a word the items write with a capital wherever it stands, at least once inside a sentence;
    a unit is a lower-case word after a number. The type depends on the lower-cased word and on all items
    together, so equal words have equal codes in a test item and in a document, whatever their case there.
    The lexicon holds the words of the stated items once, however large the corpus.
    """
    uses = items.select("text").mapInArrow(_uses, "word string, capital boolean, lower boolean, inside boolean, after_number boolean")
    words = uses.groupBy("word").agg(*[F.max(c).alias(c) for c in ("capital", "lower", "inside", "after_number")])
    kind = F.when(F.col("inside") & ~F.col("lower"), NAME).when(F.col("after_number"), UNIT).otherwise(0)
    return {r["word"]: NUMBER if _is_number(r["word"]) else r["kind"] or _word_code(r["word"]) for r in words.select("word", kind.alias("kind")).toLocalIterator()}


def _word_code(w: str) -> int:
    return xxh3_64_intdigest(w.encode("utf-8", "replace")) | _FIRST_WORD


def _window_hashes(codes: np.ndarray, window: int) -> np.ndarray:
    n = len(codes)
    if n < window:
        return np.empty(0, np.uint64)
    power, back = np.full(n, _BASE), np.full(n, _INVERSE)
    power[0] = back[0] = 1
    np.cumprod(power, out=power)
    np.cumprod(back, out=back)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_mix((codes + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)) * power, out=prefix[1:])
    return _mix((prefix[window:] - prefix[: n - window + 1]) * back[: n - window + 1])


def _codes(words: list[str], code: dict[str, int]) -> list[int]:
    """Codes of a text's words: known words as in the items, others a number or a name by their shape, else 0."""
    out = [code.get(w, -1) for w in [w.lower() for w in words]]
    if -1 in out:
        for i, c in enumerate(out):
            if c < 0:
                w = words[i]
                out[i] = NUMBER if _is_number(w) else NAME if w[0].isupper() else 0
    return out


def _windows(code, window: int, near=None):
    """(id, at, h, words) of every window of (id, text) without unknown words; with a filter, of those that it may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = code.value
        bits = None if near is None else near.value
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= 1_000_000):
                    size += len(texts[to])
                    to += 1
                words = [_WORD.findall(x) for x in texts[at:to]]
                flat: list[int] = []
                for w in words:
                    flat += _codes(w, known)
                    flat.append(0)  # no window reaches into the next text
                codes = np.array(flat, np.uint64)
                h = _window_hashes(codes, window)
                broken = np.concatenate([[0], np.cumsum(codes == 0)])
                ok = broken[window:] == broken[: len(h)]
                if bits is not None:
                    ok &= (bits[((h >> np.uint64(6)) % np.uint64(len(bits))).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1
                spot = np.flatnonzero(ok)
                begin = np.cumsum([0, *(len(w) + 1 for w in words)])
                who = np.searchsorted(begin, spot, "right") - 1
                start = spot - begin[who]
                own = [[w.lower() for w in words[d][i : i + window]] for d, i in zip(who.tolist(), start.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:to][who], pa.int64()), pa.array(start, pa.int32()), pa.array(h[spot].view(np.int64)), pa.array(own, pa.list_(pa.string()))], names=["id", "at", "h", "words"]
                )
                at = to

    return run


_WINDOW = "id bigint, at int, h bigint, words array<string>"


def _filter(windows: DataFrame, longs: int) -> np.ndarray:
    """A bit for every window hash, in `longs` words of 64: at most so many rows come to the driver, whatever the items."""
    place = F.pmod(F.shiftrightunsigned("h", 6), F.lit(longs))
    rows = windows.groupBy(place.alias("place")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    out = np.zeros(longs, np.uint64)
    for r in rows.toLocalIterator():
        out[r["place"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


def _slots(code, window: int):
    """Compares the words of joined windows: (doc, item, at, start, exact, literal, consistent)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = code.value
        for batch in batches:
            doc, item, at, start, words, other = (batch.column(i) for i in range(6))
            exact, literal, consistent = [], [], []
            for mine, own in zip(words.to_pylist(), other.to_pylist()):
                forth: dict = {}
                back: dict = {}
                fixed, ok = 0, True
                for w, o in zip(mine, own):
                    kind = known[o]
                    if kind >= _FIRST_WORD:
                        fixed += 1
                        ok &= w == o  # else the hashes have collided
                    elif forth.setdefault((kind, o), w) != w or back.setdefault((kind, w), o) != o:
                        ok = False
                exact.append(mine == own)
                literal.append(fixed)
                consistent.append(ok)
            yield pa.RecordBatch.from_arrays([doc, item, at, start, pa.array(exact, pa.bool_()), pa.array(literal, pa.int32()), pa.array(consistent, pa.bool_())], names=["doc", "item", "at", "start", "exact", "literal", "consistent"])

    return run


def leaked_windows(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text_col: str = "text", window: int = 12, min_literal: int = 5, filter_longs: int = 1 << 18) -> DataFrame:
    """(doc, item, exact, changed): how many windows of `window` words a document has in common with an item.

    Method: numbers, names and units become typed placeholders, windows of the templates are joined by
    their hash, and the words in the slots decide: `exact` windows have every word equal (lower-cased);
    `changed` ones have at least `min_literal` words outside slots and fill the slots one-to-one with
    other values, a re-parameterised item. Equal words have equal codes, so no exact window is missed.

    The lexicon of the stated items (each of their words once) and a filter of `filter_longs` * 64 bits for
    their windows go to the executors; windows of documents that pass the filter are joined with the table
    of the items' windows, so the items may be any number and the corpus is read once. Null and short
    texts match nothing; no items give no rows; a repeated document row counts once; other columns are
    ignored.
    """
    sc = docs.sparkSession.sparkContext
    read = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter(F.length("text") >= 2 * window - 1)
    stated = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null").distinct()
    code = sc.broadcast(lexicon(stated))
    templates = pin_table(stated.mapInArrow(_windows(code, window), _WINDOW))
    near = sc.broadcast(_filter(templates, filter_longs))
    hits = read.mapInArrow(_windows(code, window, near), _WINDOW)
    met = hits.join(templates.select("h", F.col("id").alias("item"), F.col("at").alias("start"), F.col("words").alias("own")), "h").select(F.col("id").alias("doc"), "item", "at", "start", "words", "own")
    told = met.mapInArrow(_slots(code, window), "doc bigint, item bigint, at int, start int, exact boolean, literal int, consistent boolean")
    changed = ~F.col("exact") & F.col("consistent") & (F.col("literal") >= min_literal)
    told = told.select("doc", "item", "at", "start", "exact", changed.alias("changed")).filter("exact or changed").distinct()
    return told.groupBy("doc", "item").agg(F.count_if("exact").cast("int").alias("exact"), F.count_if("changed").cast("int").alias("changed"))


def leaked_items(found: DataFrame) -> DataFrame:
    """(item_id, n_documents, n_exact, n_changed_only) of the items that leaked."""
    return found.groupBy(F.col("item").alias("item_id")).agg(
        F.count("*").alias("n_documents"), F.sum((F.col("exact") > 0).cast("long")).alias("n_exact"), F.sum((F.col("exact") == 0).cast("long")).alias("n_changed_only")
    )
