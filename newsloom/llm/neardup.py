"""Groups of near-equal texts: signature-coordinate inverted join, exact check, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.canon import canonical
from newsloom.operators.graph import connected_components
from newsloom.runtime import pin, pin_table

_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Signature:
    """`minima` min-hashes of the shingles; a coordinate is a fixed choice of `width` of them.

    Two documents collide in a coordinate if all its minima are equal, with odds s^width for a similarity
    s; pairs with `match` collisions or more among the `coordinates` are candidates. Such a pair collides
    at least once among any coordinates - match + 1 of them (the prefix), so only those are posted; the
    others are skipped in the merge and probed, by 18 bits that travel along. Simulated odds of finding a
    single link by default: 0.962 at 0.65, 0.991 at 0.70, 0.999 at 0.75. Three bits of `sketch` minima (58 at
    most) travel along too; a pair that agrees in fewer than `agree` of the 58 (40.3 are expected at 0.65,
    17.4 at 0.2) is skipped, which a pair of similarity 0.65 fails with odds of 0.004, counted above. A list of over
    `block` postings is merged block against block, by as many tasks as there are pairs of blocks.
    """

    shingle: int = 3
    minima: int = 64
    width: int = 4
    coordinates: int = 36
    match: int = 2
    sketch: int = 58
    agree: int = 31
    block: int = 16384
    seed: int = 20240229

    @property
    def prefix(self) -> int:
        return self.coordinates - self.match + 1

    @property
    def probe_bits(self) -> int:
        return 18 // max(1, self.match - 1)


def story_text(title: Column, summary: Column) -> Column:
    """Title, a space and summary in one consistent form, lower case, only letters and digits, single spaces."""
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit("")))
    return F.trim(F.regexp_replace(F.lower(canonical(text)), r"[^\p{L}\p{N}]+", " "))


def shingle_hashes(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint32) of every run of k code points of the joined texts, and the bounds [begin, end) of each text's own."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = np.zeros(max(0, len(codes) - k + 1), np.uint64)
    for i in range(k):
        h = h * np.uint64(0x100000001B3) + codes[i : i + len(h)]
    h = (h ^ (h >> np.uint64(29))) * _MIX
    h = (h ^ (h >> np.uint64(32))).astype(np.uint32)
    end = np.cumsum(lengths)
    begin = end - lengths
    bounds = np.empty(2 * len(texts), np.int64)
    bounds[::2] = begin
    bounds[1::2] = end - k + 1
    return h, bounds


def signatures(texts: list[str], s: Signature) -> np.ndarray:
    """minima x texts (uint32); every text has at least `shingle` characters."""
    h, bounds = shingle_hashes(texts, s.shingle)
    rng = np.random.default_rng(s.seed)
    mul = (rng.integers(1, 2**32, s.minima, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    add = rng.integers(0, 2**32, s.minima, dtype=np.uint64).astype(np.uint32)
    last = bounds[-1] == len(h)
    cut = bounds[:-1] if last else bounds
    out = np.empty((s.minima, len(texts)), np.uint32)
    buf = np.empty_like(h)
    for j in range(s.minima):
        np.multiply(h, mul[j], out=buf)
        np.add(buf, add[j], out=buf)
        out[j] = np.minimum.reduceat(buf, cut)[::2]
    return out


_POSTING = "key bigint, doc bigint, s0 bigint, s1 bigint, s2 bigint"
_PAIRS = f"a bigint, b bigint, met int, {_POSTING}, block int"
_LOW, _LOW_BITS, _HIGH_BITS = np.uint64((1 << 58) - 1), np.uint64(58), np.uint64(6)


def _coordinate(sig: np.ndarray, number: int, pick: np.ndarray) -> np.ndarray:
    k = np.full(sig.shape[1], np.uint64(number + 1)) * _MIX
    for j in pick:
        k = (k ^ sig[j]) * np.uint64(0xFF51AFD7ED558CCD)
        k ^= k >> np.uint64(33)
    return k


def _postings(s: Signature):
    """Postings (key, doc, s0, s1, s2) of the prefix.

    Bit j of the three words is a bit of the minimum j, the sketch; the high 6 bits of each are the probes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(s.seed + 1)
        chosen = [rng.choice(s.minima, s.width, replace=False) for _ in range(s.coordinates)]
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                sig = signatures(part.column(1).to_pylist(), s)
                probes = np.zeros(sig.shape[1], np.uint64)
                for i, c in enumerate(range(s.prefix, s.coordinates)):
                    probe = _coordinate(sig, c, chosen[c]) & np.uint64((1 << s.probe_bits) - 1)
                    probes |= probe << np.uint64(i * s.probe_bits)
                words = [(probes >> (_HIGH_BITS * np.uint64(k))) << _LOW_BITS for k in range(3)]
                for i in range(s.sketch):
                    for k, w in enumerate(words):
                        w |= ((sig[i] >> np.uint32(k)) & np.uint32(1)).astype(np.uint64) << np.uint64(i)
                keys = np.concatenate([_coordinate(sig, c, chosen[c]) for c in range(s.prefix)])
                doc = part.column(0).to_numpy()
                cols = [keys, *(np.tile(x, s.prefix) for x in (doc, *words))]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], names=["key", "doc", "s0", "s1", "s2"])

    return run


def _alike(s: Signature, pairs) -> np.ndarray:
    """Where the sketch does not rule out a pair; pairs: both sides of each word, of shapes that go together."""
    differ = np.uint64(0)
    for x, y in pairs:
        differ = differ | (x ^ y)
    return np.bitwise_count(differ & _LOW) <= s.sketch - s.agree


def _collisions(s: Signature, cols, places):
    """[(a, b, met)] of the pairs of postings at `places`, pairs of arrays; met: 1 and the probes that collide."""
    if not places:
        return []
    x, y = (np.concatenate(p) for p in zip(*places))
    a, b = cols[0][x], cols[0][y]
    probes = np.zeros(len(a), np.uint64)
    for k, w in enumerate(cols[1:]):
        probes |= ((w[x] ^ w[y]) >> _LOW_BITS) << (_HIGH_BITS * np.uint64(k))
    met = np.ones(len(a), np.int32)
    for i in range(s.match - 1):
        met += ((probes >> np.uint64(i * s.probe_bits)) & np.uint64((1 << s.probe_bits) - 1)) == 0
    return [(np.minimum(a, b), np.maximum(a, b), met)]


def _between(s: Signature, cols, left: np.ndarray, right: np.ndarray, tile: int = 64, span: int = 1024):
    """Places of the collisions of two ranges of postings, or inside one range if they are the same, that the sketch does not rule out."""
    rows = [w[left][:, None] for w in cols[1:]]
    other = [w[right] for w in cols[1:]]
    for i in range(0, len(left), tile):
        for j in range(i if left is right else 0, len(right), span):
            x, y = np.nonzero(_alike(s, [(p[i : i + tile], q[j : j + span]) for p, q in zip(rows, other)]))
            x, y = x + i, y + j
            if left is right:
                x, y = x[x < y], y[x < y]
            if len(x):
                yield left[x], right[y]


def _short_runs(s: Signature, cols, begin, end):
    """Places of the collisions inside many runs [begin, end): short runs of one length are paired at once, by the distance inside the run."""
    size = end - begin
    for k in np.unique(size[size > 1]):
        at = begin[size == k]
        if k <= 24:
            place = at[:, None] + np.arange(k)[None, :]
            words = [w[place] for w in cols[1:]]
            for d in range(1, k):
                i, j = np.nonzero(_alike(s, [(w[:, :-d], w[:, d:]) for w in words]))
                if len(i):
                    yield place[i, j], place[i, j + d]
        else:
            for b in at:
                rows = np.arange(b, b + k)
                yield from _between(s, cols, rows, rows)


def _pair_rows(found, hot=()) -> pa.RecordBatch:
    """Collisions, and after them the postings of long lists with the number of their block."""
    a, b, met = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
    n, m = len(a), sum(len(h[0]) for h in hot)
    head = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(met, pa.int32())]
    tail = [np.concatenate([h[i] for h in hot]) if hot else np.empty(0, np.int64) for i in range(5)]
    block = np.concatenate([np.full(len(h[0]), h[5]) for h in hot]) if hot else np.empty(0, np.int64)
    cols = [pa.concat_arrays([c, pa.nulls(m, c.type)]) for c in head]
    cols += [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c.view(np.int64), pa.int64())]) for c in tail]
    cols.append(pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(block, pa.int32())]))
    return pa.RecordBatch.from_arrays(cols, names=["a", "b", "met", "key", "doc", "s0", "s1", "s2", "block"])


def _merge(s: Signature):
    """Merges the sorted posting lists. Lists of one posting are skipped; at most a block of the open list is held.

    A list of over `block` postings is paired inside each block here, and its postings are handed on for
    the pairs between blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[np.ndarray] | None = None  # the postings of the open list that no block has taken
        blocks = 0  # and how many blocks it has given

        def give(cols, final):
            nonlocal open_, blocks
            key, rest = cols[0], cols[1:]
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            begin, end = edge[:-1].copy(), edge[1:]
            short, found, hot = [], [], []
            open_ = None
            for i in np.flatnonzero((end - begin > s.block) | (np.arange(len(begin)) == 0) & (blocks > 0) | (np.arange(len(begin)) == len(begin) - 1)):
                b, e, last = begin[i], end[i], i == len(begin) - 1 and not final
                number = blocks if i == 0 else 0
                while e - b > s.block or (number > 0 and not last and e > b):
                    to = min(b + s.block, e)
                    rows = np.arange(b, to)
                    found += _between(s, rest, rows, rows)
                    hot.append([*(c[b:to] for c in cols), number])
                    b, number = to, number + 1
                if last:
                    open_, blocks = [c[b:] for c in cols], number
                elif e > b:
                    short.append((b, e))
                begin[i] = end[i]
            begin, end = np.r_[begin, [x[0] for x in short]].astype(np.int64), np.r_[end, [x[1] for x in short]].astype(np.int64)
            found += _short_runs(s, rest, begin, end)
            found = _collisions(s, rest, found)
            if final:
                open_ = None
            if found or hot:
                yield _pair_rows(found, hot)

        new: list[list[np.ndarray]] = []

        def joined():
            cols = [np.concatenate(c) for c in zip(*([open_] if open_ is not None else []), *new)]
            new.clear()
            return cols

        for batch in batches:
            if batch.num_rows:
                cols = [batch.column(i).to_numpy() for i in range(5)]
                new.append([c.view(np.uint64) if i > 1 else c for i, c in enumerate(cols)])
            if sum(len(c[0]) for c in new) >= 1 << 16:  # lists of one length are paired at once, so few batches are slow
                yield from give(joined(), False)
        cols = joined()
        if cols and len(cols[0]):
            yield from give(cols, True)

    return run


def _block_pairs(s: Signature):
    """Collisions between the two blocks of each (key, lo, hi), whose postings come sorted by their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "lo", "hi", "block", "doc", "s0", "s1", "s2"]
        held: list[pa.RecordBatch] = []  # two blocks at most

        def give():
            t = pa.Table.from_batches(held)
            block, lo = t["block"].to_numpy(), t["lo"].to_numpy()
            cols = [t["doc"].to_numpy(), *(t[c].to_numpy().view(np.uint64) for c in names[5:])]
            found = _collisions(s, cols, list(_between(s, cols, np.flatnonzero(block == lo), np.flatnonzero(block != lo))))
            held.clear()
            return _pair_rows(found)

        for batch in batches:
            cols = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            edge = np.flatnonzero(np.r_[True, (cols[:, 1:] != cols[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for b, e in zip(edge, [*edge[1:], batch.num_rows]):
                part = pa.RecordBatch.from_arrays(list(batch.slice(b, e - b).columns), names=names)
                if held and any(held[-1].column(i)[0].as_py() != part.column(i)[0].as_py() for i in range(3)):
                    yield give()
                held.append(part)
        if held:
            yield give()

    return run


@lru_cache(maxsize=512)
def _grams(text: str, k: int) -> frozenset:
    return frozenset(text[i : i + k] for i in range(len(text) - k + 1))


def _verify(k: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                gx, gy = _grams(x, k), _grams(y, k)
                both = len(gx & gy)
                keep.append(both >= threshold * (len(gx) + len(gy) - both) - 1e-9)
            out = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1)], names=["a", "b"])

    return run


def candidate_pairs(texts: DataFrame, s: Signature = Signature()) -> DataFrame:
    """Pairs (a, b) of texts(doc bigint, text string of at least `shingle` characters) that collide in `match` coordinates or more.

    Documents are posted under each coordinate-value pair of their prefix; the posting lists are
    hash-partitioned and sorted by that key and merged as a stream, the skipped coordinates are probed,
    and the collisions of a pair are summed over all lists. Long lists are spread over (key, block, block).
    """
    post = texts.mapInArrow(_postings(s), _POSTING)
    lists = post.repartition("key").sortWithinPartitions("key", "doc")
    met = pin_table(lists.mapInArrow(_merge(s), _PAIRS))
    long_ = met.filter("block is not null").select("key", "doc", "s0", "s1", "s2", "block")
    blocks = long_.groupBy("key").agg(F.max("block").alias("last")).filter("last > 0")
    each = long_.join(blocks, "key").withColumn("other", F.explode(F.sequence(F.lit(0), "last"))).filter("other <> block")
    each = each.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "doc", "s0", "s1", "s2")
    spread = each.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "block").mapInArrow(_block_pairs(s), _PAIRS)
    found = met.filter("a is not null").select("a", "b", "met").union(spread.select("a", "b", "met"))
    # every row counts its own list; the probes are the same in all lists of a pair
    return found.groupBy("a", "b").agg((F.count("*") + F.max("met") - 1).alias("n")).filter(F.col("n") >= s.match).select("a", "b")


def close_pairs(texts: DataFrame, threshold: float = 0.65, s: Signature = Signature()) -> DataFrame:
    """Candidate pairs whose exact shingle overlap (Jaccard) reaches the threshold."""
    pairs = candidate_pairs(texts, s)
    with_texts = (
        pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
    )
    return with_texts.mapInArrow(_verify(s.shingle, threshold), "a bigint, b bigint")


def near_duplicate_groups(rows: DataFrame, id_col: str, text_col: str, threshold: float = 0.65, min_chars: int = 80, s: Signature = Signature()) -> DataFrame:
    """(id, group_id, n_links) for each row whose text has `min_chars` characters or more.

    Equal texts are one node, so a text with a third of all rows costs one posting per coordinate. Nodes
    whose texts' shingle sets overlap by `threshold` are linked, groups are the connected components and
    group_id is the least id in it; n_links counts the different texts a row's text is close to. Null,
    short and empty texts take no part; repeated ids keep one row; other columns are ignored.
    """
    min_chars = max(min_chars, s.shingle)
    own = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter(F.length("text") >= min_chars)
    own = pin_table(own.select("id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text"))
    texts = pin_table(own.groupBy("k1", "k2").agg(F.min("id").alias("doc"), F.first("text").alias("text")))
    links = pin(close_pairs(texts.select("doc", "text"), threshold, s))
    component = connected_components(links, "a", "b")
    count = links.select(F.explode(F.array("a", "b")).alias("doc")).groupBy("doc").agg(F.count("*").cast("int").alias("n_links"))
    linked = component.select(F.col("node").alias("doc"), "component").join(count, "doc")
    named = texts.select("k1", "k2", "doc").join(linked, "doc", "left").select("k1", "k2", F.coalesce("component", "doc").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return own.select("id", "k1", "k2").distinct().join(named, ["k1", "k2"]).select(F.col("id").alias(id_col), "group_id", "n_links")


def story_groups(raw_items: DataFrame, threshold: float = 0.65, min_chars: int = 80) -> DataFrame:
    """Groups of raw_items that tell the same story in nearly the same title and summary."""
    rows = raw_items.select("ingest_seq", story_text(F.col("title"), F.col("summary")).alias("story"))
    return near_duplicate_groups(rows, "ingest_seq", "story", threshold, min_chars)


def pairs_within(groups: DataFrame, id_col: str) -> DataFrame:
    """Every pair of rows of one group, smaller id first; groups of one row are left out before the join."""
    several = groups.groupBy("group_id").agg(F.count("*").alias("n")).filter("n > 1").select("group_id")
    members = groups.join(several, "group_id").select("group_id", F.col(id_col).alias("x"))
    return members.join(members.withColumnRenamed("x", "y"), "group_id").filter("x < y").select(F.col("x").alias(f"{id_col}_a"), F.col("y").alias(f"{id_col}_b"))
