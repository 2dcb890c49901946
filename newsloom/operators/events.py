"""Reports of one event: similarity joins, first-fit buckets and transitive groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions import text
from newsloom.operators.graph import connected_components
from newsloom.runtime import drop_table, pin_table


def _title_spans(items: DataFrame, id_col: str, title: str, group: str, at: str, hours: float, stop: Sequence[str], kept: Sequence[str], carried: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, named, spans): items with the columns `kept` of g, w and their own, their spells, and the nodes of the spells with the columns `carried` of their first item."""
    words = text.word_array(F.col(title), 2, stop)
    t = F.unix_micros(F.col(at).cast("timestamp"))
    width = int(hours * 3_600_000_000)
    own = [c for c in (*kept, *carried) if c not in ("g", "w")]
    base = items.select(F.col(id_col).alias("id"), F.col(group).alias("g"), t.alias("t"), *own, F.explode(F.array(F.sort_array(words))).alias("w")).filter((F.size("w") > 0) & F.col("t").isNotNull())
    base = pin_table(base.select("id", "t", *kept, *carried, F.xxhash64("g", "w").alias("s"), F.floor(F.col("t") / width).alias("spell")))
    spells = base.groupBy("s", "spell").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.min_by(F.struct("id", *carried), F.struct("t", "id")).alias("first"))
    order = W.partitionBy("s").orderBy("spell")
    opened = spells.withColumn("new", F.coalesce((F.col("t0") - F.lag("t1").over(order) > width).cast("int"), F.lit(1))).withColumn("burst", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    named = opened.withColumn("first", F.first("first").over(W.partitionBy("s", "burst").orderBy("spell").rowsBetween(W.unboundedPreceding, 0)))
    named = pin_table(named.select("s", "spell", F.col("first.id").alias("node"), *(F.col(f"first.{c}") for c in carried), "t0", "t1"))
    spans = named.groupBy("s", "node").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1"), *(F.first(c).alias(c) for c in carried))
    return base, named, spans


def _members(base: DataFrame, named: DataFrame) -> DataFrame:
    return base.select("id", "s", "spell").join(named.select("s", "spell", "node"), ["s", "spell"]).select("id", "node")


def title_nodes(items: DataFrame, id_col: str, title: str, group: str, at: str, hours: float, stop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): items of one group with the same title words, as long as none is `hours` after the one before.

    nodes(node, g, w, t0, t1) are named by their first item; members(id, node) has every item with words.
    Items are first summed up per spell of `hours`, in partial sums, and only the spells are put in order,
    so a title on a third of all items is never sorted in one task. Words are taken once and written; sums and
    order carry only their hash, and each node gets its words at the end. Items without words or time are left out.
    """
    base, named, spans = _title_spans(items, id_col, title, group, at, hours, stop, ["g", "w"])
    worded = spans.join(base.select(F.col("id").alias("node"), "s", "g", "w"), ["node", "s"]).groupBy("node", "s").agg(*(F.first(c).alias(c) for c in ("g", "w", "t0", "t1")))
    nodes = pin_table(worded)  # an item that came twice gives one
    return nodes, _members(base, named)


def title_spans(items: DataFrame, id_col: str, title: str, group: str, at: str, hours: float, carried: Sequence[str], stop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Like `title_nodes`, for those who take the texts from the items: nodes(node, t0, t1) have no words but the columns `carried` of their first item."""
    base, named, spans = _title_spans(items, id_col, title, group, at, hours, stop, [], carried)
    return spans.drop("s"), _members(base, named)


def posted_words(sets: DataFrame, words: str, keep: Column) -> DataFrame:
    """(node, gh, t0, t1, n, bits, i, h) of the rarest `keep` words of each of sets(node, gh, t0, t1, words), the rarest first.

    n is the number of words and i the place of this one; h and the set of four `bits` words stand for the
    words by their hashes, so a posting is small whatever the words are. `keep` may speak of n.
    """
    each = sets.select("node", "gh", "t0", "t1", F.explode(words).alias("x"))
    seen = each.groupBy("x").agg(F.count("*").alias("seen"))
    bit = [F.expr(f"bit_or(if((h >> 6 & 3) = {i}, shiftleft(1L, cast(h & 63 as int)), 0L))").alias(f"bits{i}") for i in range(4)]
    hashed = each.join(seen, "x").select("node", "gh", "t0", "t1", "seen", F.xxhash64("x").alias("h"))
    ranked = hashed.groupBy("node", "gh", "t0", "t1").agg(F.sort_array(F.collect_list(F.struct("seen", "h"))).alias("o"), *bit).withColumn("n", F.size("o"))
    post = ranked.select("node", "gh", "t0", "t1", "n", *(f"bits{i}" for i in range(4)), F.posexplode(F.slice("o", F.lit(1), F.greatest(F.lit(0), keep).cast("int"))).alias("i", "o"))
    return post.withColumn("h", F.col("o.h")).drop("o")


def met_postings(post: DataFrame, width: int, shared: Column) -> DataFrame:
    """(a, b), a < b, of nodes of one group within `width` of each other whose postings meet and that may share `shared` words.

    The later of two nodes (by t0) stands in the spell of its t0 alone, the earlier one in all spells in which
    a node within its reach may begin, so work grows with the time covered and a pair meets once a word.
    `shared` speaks of p.n and q.n. At their first common word the words left must suffice, and the words
    that the bits show to be missing in the other set may not be too many; both lose nothing.
    """
    spell = lambda c: F.floor(c / max(width, 1))
    late = post.withColumn("k", F.xxhash64("h", "gh", spell(F.col("t0"))))
    early = post.withColumn("spell", F.explode(F.sequence(spell(F.col("t0")), spell(F.col("t1") + width)))).withColumn("k", F.xxhash64("h", "gh", "spell")).drop("spell")
    p, q = early.alias("p"), late.alias("q")
    first = (F.col("p.t0") < F.col("q.t0")) | (F.col("p.t0") == F.col("q.t0")) & (F.col("p.node") < F.col("q.node"))
    near = F.col("q.t0") - F.col("p.t1") <= width
    lacks = lambda x, y: sum((F.bit_count(F.col(f"{x}.bits{i}").bitwiseAND(F.bitwise_not(f"{y}.bits{i}"))) for i in range(4)), F.lit(0))
    enough = F.lit(True)
    for x, y in ("pq", "qp"):
        enough = enough & (F.col(f"{x}.n") - F.col(f"{x}.i") >= shared) & (F.col(f"{x}.n") - lacks(x, y) >= shared)
    met = p.join(q, F.col("p.k") == F.col("q.k")).filter(first & near & enough)
    return met.select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()


def hash_bits(lists: pa.ListArray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, slack, n) of each list of hashes: 64 * `size` bits in uint64 words, how many of its n members set no bit of their own."""
    n = np.diff(lists.offsets.to_numpy())
    h = lists.flatten().to_numpy().view(np.uint64)
    bits = np.zeros(size * len(n), np.uint64)
    word = ((h >> np.uint64(6)) % np.uint64(size)).astype(np.int64)
    np.bitwise_or.at(bits, word * len(n) + np.repeat(np.arange(len(n)), n), np.uint64(1) << (h & np.uint64(63)))
    bits = bits.reshape(size, len(n))
    return bits, n - np.bitwise_count(bits).sum(axis=0, dtype=np.int64), n


@F.arrow_udf(T.StructType([T.StructField("bits", T.BinaryType()), T.StructField("slack", T.IntegerType()), T.StructField("n", T.IntegerType())]))
def gram_bits(texts: pa.Array) -> pa.Array:
    """The pairs of neighbouring characters of a text, the i-th of one kind apart from the others, as `hash_bits` has sets of hashes."""
    values = texts.to_pylist()
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    points = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(values)), lengths)
    inner = np.flatnonzero(row[1:] == row[:-1])
    key = np.sort(row[inner].astype(np.uint64) << np.uint64(42) | points[inner] << np.uint64(21) | points[inner + 1])
    gram = key & np.uint64(2**42 - 1)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    nth = np.arange(len(gram)) - np.repeat(first, np.diff(np.r_[first, len(gram)]))
    h = gram << np.uint64(20) ^ nth.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(factor)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.maximum(lengths - 1, 0))], pa.int32()), pa.array(h.view(np.int64)))
    bits, slack, n = hash_bits(lists, 8)
    return pa.StructArray.from_arrays([pa.array([b.tobytes() for b in np.ascontiguousarray(bits.T)], pa.binary()), pa.array(slack, pa.int32()), pa.array(n, pa.int32())], ["bits", "slack", "n"])


def like_texts(least: float) -> dict[str, float]:
    """The bound of `near_sets` for `gram_bits` of texts whose matching-blocks ratio is `least` or more.

    Texts of x and y characters match in m >= least * (x + y) / 2. A character without a match lies between
    two blocks, so there are at most x + y - 2m + 1 blocks, and m less their number of pairs of characters are shared.
    """
    share = 1.5 * least - 1
    return {"least": share / (1 - share), "plus": 2 * share - 1}


def _near_sets(width: int, least: float, tile: int = 128, span: int = 4096, plus: float = 0.0, smaller: bool = False, fold: int = 2):
    """Pairs (a, b) of rows(cell, t0, node, t1, here, h) sorted by cell, t0 and node whose hashed words may overlap by `least`.

    A row that is `here` meets the earlier ones of its cell within reach. Sets that overlap by `least` share
    `least` of the larger one; the bits they share and the members of the smaller set without a bit of their
    own are the most they can share. 64 * `fold` bits, folded from 512, judge tiles of pairs and all 512 the rest.
    Sets of n and m members are to share `plus` more than an overlap by `least` takes, or, where `smaller`, `least` of the smaller one.
    Rows may bring bits, slack and n instead of h; those that bring an equal `own` are not paired.
    """
    flat = ("node", "t0", "t1", "here")
    either = np.minimum if smaller else np.maximum

    def rows(batch: pa.RecordBatch) -> list[np.ndarray]:
        names = batch.schema.names
        if "h" in names:
            bits, slack, n = hash_bits(batch["h"], 8)
        else:
            bits = np.frombuffer(b"".join(batch["bits"].to_pylist()), np.uint64).reshape(-1, 8).T
            slack, n = (batch[c].to_numpy().astype(np.int64) for c in ("slack", "n"))
        folded = np.bitwise_or.reduce(bits.reshape(8 // fold, fold, -1), axis=0)
        most = lambda c: np.minimum(c, 2**14).astype(np.int16)
        loose = most(n - np.bitwise_count(folded).sum(axis=0, dtype=np.int64))
        need = np.maximum(n * least, 1) if smaller else n * least + plus * (1 + least)
        own = batch["own"].to_numpy() if "own" in names else batch["node"].to_numpy()
        return [*(batch[c].to_numpy(zero_copy_only=False) for c in flat), n, bits, slack, folded, loose, most(np.ceil(need - 1e-6)), own]

    def pairs(every: list[np.ndarray], start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        node, t0, t1, here, n, bits, slack, folded, loose, need, own = every
        last = np.maximum.accumulate(t1)
        late = start + np.flatnonzero(here[start:])
        for x in (late[i : i + tile] for i in range(0, len(late), tile)):
            for at in range(np.searchsorted(last, t0[x[0]] - width), x[-1], span):
                y = slice(at, min(at + span, x[-1]))
                met = np.minimum(loose[x][:, None], loose[None, y])
                for f in folded:
                    met += np.bitwise_count(f[x][:, None] & f[None, y])
                j, i = np.nonzero(met >= either(need[x][:, None], need[None, y]))
                j, i = x[j], i + at
                keep = (i < j) & (t0[j] - t1[i] <= width) & (own[j] != own[i])
                j, i = j[keep], i[keep]
                common = np.bitwise_count(bits[:, j] & bits[:, i]).sum(axis=0, dtype=np.int64) + np.minimum(slack[j], slack[i])
                keep = common >= (np.maximum(np.minimum(n[j], n[i]) * least, 1) if smaller else (n[j] + n[i]) * (least / (1 + least)) + plus) - 1e-6
                if keep.any():
                    yield node[j[keep]], node[i[keep]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cell = None, None
        for batch in batches:
            cells = batch["cell"].to_numpy()
            cuts = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1), len(cells)] if len(cells) else [0]
            new = rows(batch) if len(cells) else []
            for begin, end in zip(cuts, cuts[1:]):
                if cells[begin] != cell:
                    held, cell = None, cells[begin]
                every = [c[..., begin:end] for c in new]
                start = 0
                if held is not None:
                    start, every = len(held[0]), [np.concatenate(c, axis=-1) for c in zip(held, every)]
                for x, y in pairs(every, start):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
                near = every[2] + width >= every[1][-1]
                held = [c[..., near] for c in every]

    return run


def near_sets(sets: DataFrame, least: float, width: int, hot: int = 20_000, **bound) -> DataFrame:
    """(a, b), a < b, of sets(node, gh, t0, t1, h) of one group within `width` of each other whose hashes h may overlap by `least`; loses no pair.

    Sets may have bits, slack and n for h, and `own`; these and the other bounds are those of `_near_sets`.

    A set stands in the cell of its group and its four spells of `width`, and in the next ones its reach
    extends to; there a stream compares it with the earlier ones in reach. The later sets of a cell with more than
    `hot` of them are dealt out to several streams.
    """
    cell = lambda c: F.floor(c / (4 * max(width, 1)))
    own = sets.withColumn("at", F.explode(F.sequence(cell(F.col("t0")), cell(F.col("t1") + width)))).withColumn("here", F.col("at") == cell(F.col("t0")))
    full = pin_table(sets.select("gh", cell(F.col("t0")).alias("at")).groupBy("gh", "at").agg(F.count("*").alias("late")).filter(F.col("late") > hot))  # few, so the sets are not shuffled to meet them
    dealt = own.join(full, ["gh", "at"], "left").withColumn("of", F.coalesce(F.ceil(F.col("late") / hot), F.lit(1)).cast("int"))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    mine = F.col("here") & (F.pmod(F.xxhash64(F.lit(3), "node"), F.col("of")) == F.col("part"))
    rows = dealt.select(F.xxhash64("gh", "at", "part").alias("cell"), "t0", "node", "t1", mine.alias("here"), *(c for c in sets.columns if c in ("h", "bits", "slack", "n", "own")))
    return rows.repartition("cell").sortWithinPartitions("cell", "t0", "node").mapInArrow(_near_sets(width, least, **bound), "a bigint, b bigint")


def with_sides(pairs: DataFrame, values: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Adds to pairs(a, b), a written table, the structs p and q of the values' columns at a and at b.

    The values that a pair names are written first, so where pairs are few, values are neither shuffled nor sorted.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    own = pin_table(values.select(key, *columns).join(named, key, "left_semi"))
    side = lambda n, i: own.select(F.col(key).alias(n), F.struct(*columns).alias(i))
    return pairs.join(side("a", "p"), "a").join(side("b", "q"), "b")


def similar_nodes(nodes: DataFrame, least: float, hours: float) -> DataFrame:
    """(a, b, similarity) of nodes of one group whose word sets overlap by `least` and whose times come within `hours`; a < b.

    Lossless: hashed words of one group meet in the order of time, and only the pairs that may overlap
    enough get their words, by which they are judged. Pairs and result are written, since their size decides
    how they are joined.
    """
    width = int(hours * 3_600_000_000)
    hashed = F.transform("w", lambda w: F.xxhash64(w))
    met = pin_table(near_sets(nodes.select("node", F.xxhash64("g").alias("gh"), "t0", "t1", hashed.alias("h")), least, width))
    both = with_sides(met, nodes, "node", ["s", "g", "w"]).filter((F.col("p.s") != F.col("q.s")) & F.col("p.g").eqNullSafe(F.col("q.g")))
    return pin_table(both.select("a", "b", text.jaccard(F.col("p.w"), F.col("q.w")).alias("similarity")).filter(F.col("similarity") >= least - 1e-9))


def first_fit(items: DataFrame, edges: DataFrame, id_col: str, order: Sequence[Column]) -> DataFrame:
    """(id, bucket): each item, in `order`, joins the oldest bucket that holds an item it merges with, else opens one.

    Buckets never merge, so this is not the transitive closure. The bucket of an item is the least bucket
    among its earlier neighbours, itself if it has none, that is the first item that edges to earlier items
    lead to. It is found by rounds of joins and minima, each of which also takes the label of an item's
    label, so a chain settles in rounds that grow with the logarithm of its length. No group is replayed in
    one task. A bucket is named by its first item. Labels are written as tables, whose size is that of their files:
    a checkpoint keeps the optimizer's estimate, which joins multiply, so its digits would double with each round.
    """
    place = items.select(F.col(id_col).alias("id"), F.struct(*order, F.col(id_col)).alias("o"))
    edges = pin_table(edges.select("a", "b"))  # found once, and their size decides how they are joined
    sides = edges.join(place.select(F.col("id").alias("a"), F.col("o").alias("oa")), "a").join(place.select(F.col("id").alias("b"), F.col("o").alias("ob")), "b")
    late = F.col("ob") < F.col("oa")
    back = sides.filter("oa <> ob").select(F.when(late, F.col("a")).otherwise(F.col("b")).alias("later"), F.when(late, F.col("b")).otherwise(F.col("a")).alias("earlier"), F.least("oa", "ob").alias("ob"))
    back = pin_table(back)
    label = pin_table(back.groupBy("later").agg(F.min("ob").alias("l")))
    settled = label.isEmpty()
    while not settled:  # labels only sink, so this ends
        known = label.select(F.col("later").alias("via"), F.col("l").alias("beyond"))
        step = back.join(known, F.col("earlier") == F.col("via"), "left").select("later", F.coalesce("beyond", "ob").alias("l"))
        jump = label.join(known, F.col(f"l.{id_col}") == F.col("via")).select("later", F.col("beyond").alias("l"))
        new = pin_table(step.union(jump).groupBy("later").agg(F.min("l").alias("l")))
        settled = new.join(label.withColumnRenamed("l", "was"), "later").filter("l <> was").isEmpty()
        drop_table(label)
        label = new
    first = label.select(F.col("later").alias(id_col), F.col(f"l.{id_col}").alias("first"))
    return items.select(id_col).join(first, id_col, "left").select(id_col, F.coalesce("first", id_col).alias("bucket"))


def linked_groups(items: DataFrame, id_col: str, keys: Sequence[Column]) -> DataFrame:
    """(id, group_id): items that share any of the keys, directly or through others; null and '' keys link nothing.

    Each item links to the least item with the same key, a star instead of all pairs, so a key of a third
    of all items gives one edge per item.
    """
    rows = items.select(F.col(id_col).alias("id"), F.posexplode(F.array(*[k.cast("string") for k in keys])).alias("i", "k")).filter("k <> ''")
    hub = rows.groupBy("i", "k").agg(F.min("id").alias("hub"))
    edges = rows.join(hub, ["i", "k"]).filter("id <> hub").select(F.col("id").alias("src"), F.col("hub").alias("dst"))
    found = connected_components(edges)
    return items.select(F.col(id_col).alias("id")).join(found, F.col("id") == F.col("node"), "left").select(F.col("id").alias(id_col), F.coalesce("component", "id").alias("group_id"))


def group_summary(items: DataFrame, groups: DataFrame, id_col: str, source: str, at: str, main: Sequence[Column]) -> DataFrame:
    """One row per group: its main item by `main`, items, sources and the span of time."""
    joined = items.join(groups, id_col)
    return joined.groupBy("group_id").agg(
        F.min_by(id_col, F.struct(*main, F.col(id_col))).alias("main_id"),
        F.count("*").alias("n_items"),
        F.count_distinct(source).alias("n_sources"),
        F.min(at).alias("first_seen"),
        F.max(at).alias("last_seen"),
    )


def member_ids(df: DataFrame, key: str, id_col: str, length: int = 12) -> DataFrame:
    """(key, event_id, n) of every key with two rows or more; the id is SHA-1 over all members, sorted as text and joined by '|'.

    Members pass sorted through the hash, so a group of any size takes constant memory.
    """

    def run(batches):
        at, n, h = None, 0, None
        for batch in batches:
            out = []
            for k, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if h is not None and k == at:
                    h.update(b"|" + m.encode())
                    n += 1
                    continue
                if n > 1:
                    out.append((at, h.hexdigest()[:length], n))
                at, n, h = k, 1, hashlib.sha1(m.encode())
            yield _batch(out)
        yield _batch([(at, h.hexdigest()[:length], n)] if n > 1 else [])

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["k", "event_id", "n"])

    members = df.select(F.col(key).alias("k"), F.col(id_col).cast("string").alias("m"))
    repeated = members.groupBy("k").count().filter("count > 1").select("k")
    rows = members.join(repeated, "k", "left_semi").repartition("k").sortWithinPartitions("k", "m")
    return rows.mapInArrow(run, "k string, event_id string, n bigint").select(F.col("k").alias(key), "event_id", "n")
