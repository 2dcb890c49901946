"""Long spans that stand verbatim in more than one document, by level-wise doubling of repeated windows."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.runtime import pin, pin_table

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


@dataclass(frozen=True)
class Doubling:
    """Spans of `min_chars` code points. Windows double from `first` as long as they fit into such a span, up to `top`.

    A span of min_chars holds `slack` = min_chars - top + 1 starts at which a top window fits; the start
    with the least hash among any `slack` neighbours is an anchor, so each shared span has an anchor in
    common whatever else the documents hold. Longer windows than the span would lose spans that are just
    long enough, so doubling ends there, or earlier when no candidate is left.
    """

    min_chars: int = 300
    first: int = 128
    run_limit: int = 64

    @property
    def levels(self) -> int:
        return max(1, (self.min_chars // self.first).bit_length())

    @property
    def lengths(self) -> list[int]:
        return [self.first << i for i in range(self.levels)]

    @property
    def slack(self) -> int:
        return self.min_chars - self.lengths[-1] + 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


class Rolling:
    """Window hashes of any length over joined texts, from one prefix sum (arithmetic modulo 2^64)."""

    def __init__(self, texts: list[str]):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = len(codes)
        codes = _mix((codes + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
        power = np.full(n, _BASE)
        self.back = np.full(n, _INVERSE)
        if n:
            power[0] = self.back[0] = 1
        np.cumprod(power, out=power)
        np.cumprod(self.back, out=self.back)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * power, out=self.prefix[1:])
        self.begin = np.cumsum(self.lengths) - self.lengths

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return _mix((self.prefix[starts + length] - self.prefix[starts]) * self.back[starts])

    def all(self, length: int) -> np.ndarray:
        n = max(0, len(self.back) - length + 1)
        return _mix((self.prefix[length : length + n] - self.prefix[:n]) * self.back[:n])


def _slide(values: np.ndarray, width: int, f) -> np.ndarray:
    """f over every `width` neighbours, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = f(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return f(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(texts: list[str], p: Doubling) -> tuple[np.ndarray, np.ndarray, Rolling]:
    """(text index, start in the joined texts) of every anchor of texts of at least min_chars."""
    r = Rolling(texts)
    h = r.all(p.first)
    if len(h) < p.slack:
        return np.empty(0, np.int64), np.empty(0, np.int64), r
    least = _slide(h, p.slack, np.minimum)
    # a window of starts counts only where it, with its top windows, lies inside one text
    owner = np.repeat(np.arange(len(texts)), r.lengths)
    end = (r.begin + r.lengths)[owner]
    ok = np.arange(len(least)) + p.min_chars <= end[: len(least)]
    least = np.where(ok, least, np.uint64(0))
    padded = np.concatenate([np.zeros(p.slack - 1, np.uint64), least, np.zeros(p.slack - 1, np.uint64)])
    reach = _slide(padded, p.slack, np.maximum)[: len(h)]
    at = np.flatnonzero((reach == h) & (h > 0))
    return owner[at], at, r


def _salted(cols: np.ndarray) -> np.ndarray:
    """Sorts (doc, h0, ...) by first window and document and adds (known, salt).

    A window that two documents of this chunk hold is known to be repeated. One of its rows stays behind
    under salt 0 to tell other chunks; the others are spread by document, since nothing is left to learn
    about them. A window in a third of all documents thus meets with one row per chunk.
    """
    cols = cols[:, np.lexsort((cols[0], cols[1]))]
    doc, h = cols[0], cols[1]
    edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.diff(np.r_[edge, len(h)])
    known = np.repeat(doc[edge] != doc[edge + size - 1], size)
    salt = np.where(known, np.uint64(1) + _mix(doc * _BASE) % np.uint64(63), np.uint64(0))
    salt[edge] = 0
    return np.concatenate([cols, known.astype(np.uint64)[None, :], salt[None, :]])


def _postings(p: Doubling):
    names = ["doc", *(f"h{i}" for i in range(p.levels)), "known", "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= 1_000_000):
                    size += len(texts[to])
                    to += 1
                who, where, r = anchors(texts[at:to], p)
                if len(who):
                    cols = np.unique(np.stack([docs[at:to][who].view(np.uint64), *(r.at(where, n) for n in p.lengths)]), axis=1)
                    cols = _salted(cols).view(np.int64)
                    yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols[:-2]), pa.array(cols[-2].astype(np.int8)), pa.array(cols[-1].astype(np.int8))], names=names)
                at = to

    return run


def _repeated(level: int):
    """Keeps the anchors whose window at this level stands in two or more documents, at level 0 also those known to.

    Rows come sorted by window and document, so a run is known to be repeated at its second document: only
    rows of one document ever wait, however long the run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = first_doc = None
        several = False
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key, doc = batch.column(level + 1).to_numpy(), batch.column(0).to_numpy()
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            end = np.r_[begin[1:], len(key)]
            many = doc[begin] != doc[end - 1]
            if level == 0:
                many |= np.maximum.reduceat(batch.column(batch.num_columns - 2).to_numpy(), begin) > 0
            if key[0] == last:
                many[0] |= several or doc[end[0] - 1] != first_doc
                if many[0]:
                    yield from waiting
            else:
                first_doc = None
            if key[0] != last or many[0] or len(begin) > 1:
                waiting = []
            if len(begin) > 1 or key[0] != last:
                first_doc = doc[begin[-1]]
            last, several = key[-1], bool(many[-1])
            yield batch.filter(pa.array(np.repeat(many, end - begin)))
            if not several:
                waiting.append(batch.slice(int(begin[-1])))

    return run


def _pair_up(key: int):
    """(a, b): every pair of the documents of a run of equal keys, smaller id first."""

    def pairs(docs: np.ndarray) -> Iterator[np.ndarray]:
        for i in range(0, len(docs), 256):  # blocks of documents against all later ones
            part = docs[i : i + 256]
            x, y = np.repeat(part, len(docs) - i), np.tile(docs[i:], len(part))
            yield np.stack([x[x < y], y[x < y]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, docs, out = None, np.empty(0, np.int64), []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            k, d = batch.column(key).to_numpy(), batch.column(0).to_numpy()
            edge = np.flatnonzero(np.r_[True, k[1:] != k[:-1], True])
            for b, e in zip(edge[:-1], edge[1:]):
                own = np.unique(d[b:e])
                if k[b] == last:
                    docs = np.union1d(docs, own)
                    continue
                for block in pairs(docs) if len(docs) > 1 else ():
                    out.append(block)
                    if block.shape[1] > 50_000:
                        yield _unique(out)
                        out.clear()
                last, docs = k[b], own
            if sum(o.shape[1] for o in out) > 100_000:
                yield _unique(out)
                out.clear()
        out += pairs(docs)
        if out:
            yield _unique(out)

    return run


def _unique(out: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.unique(np.concatenate(out, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _full_windows(p: Doubling, starts: bool = False):
    """For (doc, top windows that are repeated, text): every min_chars window that holds one of them, as (doc, h), or with its start as (doc, start, h)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, keys, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                r = Rolling([text])
                top = r.all(p.lengths[-1])
                at = np.flatnonzero(np.isin(top.view(np.int64), np.array(keys, np.int64)))
                start = np.unique((at[:, None] - np.arange(p.slack)[None, :]).ravel())
                start = start[(start >= 0) & (start + p.min_chars <= len(text))]
                h = r.at(start, p.min_chars).view(np.int64)
                if starts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), doc)), pa.array(start), pa.array(h)], names=["doc", "start", "h"])
                else:
                    h = np.unique(h)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), doc)), pa.array(h)], names=["doc", "h"])

    return run


def _common(p: Doubling):
    """(a, b, spans of a, spans of b): the maximal stretches of at least min_chars that both texts hold, as flat begin, end lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def windows(doc: int, text: str) -> np.ndarray:
            if doc not in known:
                if len(known) >= 256:
                    known.popitem(last=False)
                known[doc] = Rolling([text]).all(p.min_chars)
            return known[doc]

        def spans(hit: np.ndarray) -> list[int]:
            at = np.flatnonzero(hit)
            new = np.flatnonzero(np.diff(at) > 1)
            begin, last = at[np.r_[0, new + 1]], at[np.r_[new, len(at) - 1]]
            return np.stack([begin, last + p.min_chars], 1).ravel().tolist()

        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                hx, hy = windows(a, x), windows(b, y)
                both = np.intersect1d(hx, hy)
                if len(both):
                    rows.append((a, b, spans(np.isin(hx, both)), spans(np.isin(hy, both))))
            a, b, s, t = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.list_(pa.int32())), pa.array(t, pa.list_(pa.int32()))], names=["a", "b", "s", "t"])

    return run


def _classes(docs: DataFrame, id_col: str, text_col: str, p: Doubling) -> tuple[DataFrame, DataFrame]:
    """(doc, rep) of every document long enough, and the texts of the representatives of equal texts."""
    own = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).filter(F.length("text") >= p.min_chars)
    keyed = own.select("doc", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    rep = keyed.groupBy("k1", "k2").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"))
    copies = pin(keyed.join(rep.filter("copies > 1"), ["k1", "k2"]).select("doc", "rep").distinct())
    return copies, own.join(copies.filter("doc <> rep").select("doc"), "doc", "left_anti")


def _candidates(docs: DataFrame, id_col: str, text_col: str, p: Doubling) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The classes of equal texts, one text of each, and (doc, key): the anchors whose windows up to the one before the longest are repeated."""
    copies, texts = _classes(docs, id_col, text_col, p)
    fields = ", ".join(["doc bigint", *(f"h{i} bigint" for i in range(p.levels)), "known tinyint", "salt tinyint"])
    live = texts.select("doc", "text").mapInArrow(_postings(p), fields)
    for level in range(p.levels - 1):
        met = live.repartition("h0", "salt") if level == 0 else live.repartition(f"h{level}")
        live = met.sortWithinPartitions(f"h{level}", "doc").mapInArrow(_repeated(level), fields)
    live = pin_table(live.select("doc", F.col(f"h{p.levels - 1}").alias("key")))
    return copies, texts, live


def span_pairs(docs: DataFrame, id_col: str, text_col: str, p: Doubling = Doubling()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of different texts with a common span, the classes of equal texts and the texts themselves.

    Anchors of every text are posted under the hash of their first window. Windows that stand in one
    document alone are dropped; the others go on under the hash of the window twice as long, which each
    anchor brings along, until the longest level. Its runs are paired, those of more than `run_limit`
    rows (counted with partial sums) only after a split by every window of the full length, so a passage just short of
    min_chars in a third of all documents makes no pairs. Every pair is checked against both texts.
    """
    copies, texts, live = _candidates(docs, id_col, text_col, p)
    hot = pin(live.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > p.run_limit).select("key"))
    narrow = live.join(hot, "key", "left_anti").select("doc", "key").repartition("key").sortWithinPartitions("key", "doc")
    pairs = narrow.mapInArrow(_pair_up(1), "a bigint, b bigint").distinct()
    if not hot.isEmpty():
        wide = live.join(hot, "key", "left_semi")
        grouped = wide.groupBy("doc").agg(F.collect_set("key").alias("keys"))  # at most the anchors of one text
        full = grouped.join(texts.select("doc", "text"), "doc").select("doc", "keys", "text").mapInArrow(_full_windows(p), "doc bigint, h bigint")
        more = full.repartition("h").sortWithinPartitions("h", "doc").mapInArrow(_pair_up(1), "a bigint, b bigint")
        pairs = pairs.union(more).distinct()
    checked = pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("y")), "b")
    common = checked.select("a", "b", "x", "y").mapInArrow(_common(p), "a bigint, b bigint, s array<int>, t array<int>")
    return common, copies, texts


def sharing_documents(docs: DataFrame, id_col: str, text_col: str, p: Doubling = Doubling()) -> DataFrame:
    """(a, b) of documents, smaller id first, with a common span of min_chars; equal texts included.

    Null and shorter texts share nothing; a repeated row counts once. Empty input gives no rows; other
    columns are ignored.
    """
    common, copies, _ = span_pairs(docs, id_col, text_col, p)
    of = copies.select(F.col("rep").alias("a"), F.col("doc").alias("da"))
    left = common.select("a", "b").join(of, "a", "left").select(F.coalesce("da", "a").alias("x"), "b")
    both = left.join(of.select(F.col("a").alias("b"), F.col("da").alias("db")), "b", "left").select("x", F.coalesce("db", "b").alias("y"))
    same = copies.alias("l").join(copies.alias("r"), "rep").filter("l.doc < r.doc").select(F.col("l.doc").alias("x"), F.col("r.doc").alias("y"))
    return both.union(same).select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b")).distinct()


def shared_amount(docs: DataFrame, id_col: str, text_col: str, p: Doubling = Doubling()) -> DataFrame:
    """(id, n_chars, shared_chars, n_spans, share) of every document: how much of it stands elsewhere too.

    No pairs are made: around the anchors that are repeated, every window of the full length is posted, and
    those that stand in two documents or more cover what is shared. The work follows the shared text, not
    the number of documents that share it. Overlapping spans count once. A text with an equal copy is
    shared whole. Null texts have 0 characters and share 0.
    """
    copies, texts, live = _candidates(docs, id_col, text_col, p)
    again = live.groupBy("key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("key")
    keys = live.join(again, "key", "left_semi").groupBy("doc").agg(F.collect_set("key").alias("keys"))  # at most the anchors of one text
    full = keys.join(texts.select("doc", "text"), "doc").select("doc", "keys", "text").mapInArrow(_full_windows(p, True), "doc bigint, start bigint, h bigint")
    shared = full.repartition("h").sortWithinPartitions("h", "doc").mapInArrow(_repeated(1), "doc bigint, start bigint, h bigint")
    at = shared.groupBy("doc").agg(F.array_sort(F.collect_list(F.col("start").cast("int"))).alias("v"))  # starts in one document
    step = f"aggregate(v, struct(0 AS n, 0 AS c, -1 AS hi), (m, x) -> struct(m.n + if(x > m.hi, 1, 0) AS n, m.c + {p.min_chars} - greatest(0, m.hi - x) AS c, x + {p.min_chars} AS hi))"
    part = at.select("doc", F.expr(step).alias("m")).select("doc", "m.n", "m.c")
    of = copies.select(F.col("doc"), F.lit(True).alias("copied")).distinct()
    all_ = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"))
    out = all_.join(part, "doc", "left").join(of, "doc", "left")
    shared = F.when(F.col("copied"), F.col("n_chars")).otherwise(F.coalesce("c", F.lit(0)))
    return out.select(F.col("doc").alias(id_col), "n_chars", shared.alias("shared_chars"), F.when(F.col("copied"), 1).otherwise(F.coalesce("n", F.lit(0))).alias("n_spans"), F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(0.0).alias("share"))
