"""Whether two reports are of one event: features of each, candidate pairs without a loss, and a cascade of rules."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.operators import relational as rel
from newsloom.operators.events import gram_bits, hash_bits, like_texts, near_sets
from newsloom.operators.scoring import thousandths
from newsloom.runtime import pin


@dataclass(frozen=True)
class StoryRules:
    """Word lists a user brings along, and the thresholds of the cascade.

    stop: words that are none. generic: named words that name nothing. anchors: words that tie a report to
    an event; broad: anchors too common to do so alone. families: words of one kind of action. shared:
    actions that count for broad anchors. roundups: phrases of titles that collect many events.
    """

    stop: Sequence[str] = ()
    generic: Sequence[str] = ()
    anchors: Sequence[str] = ()
    broad: Sequence[str] = ()
    families: Mapping[str, Sequence[str]] = field(default_factory=dict)
    shared: Sequence[str] = ()
    roundups: Sequence[str] = ()
    # Hours, similarities and counts of the cascade, then base, step and most of each confidence.
    hours: float = 36
    roundup_similarity: float = 0.45
    distinct_similarity: float = 0.55
    broad_similarity: float = 0.2
    anchor_count: int = 2
    anchor_words: int = 3
    anchor_hours: float = 24
    action_below: float = 0.18
    high_similarity: float = 0.6
    recent_words: int = 5
    recent_similarity: float = 0.25
    recent_hours: float = 12
    names_count: int = 2
    names_similarity: float = 0.28
    name_similarity: float = 0.42
    mixed_similarity: float = 0.2
    family_similarity: float = 0.5
    anchor_confidence: tuple[float, float, float] = (0.62, 0.04, 0.92)
    recent_confidence: tuple[float, float, float] = (0.48, 0.025, 0.86)
    names_confidence: tuple[float, float, float] = (0.55, 0.04, 0.9)
    name_confidence: tuple[float, float, float] = (0.52, 0.04, 0.86)
    mixed_confidence: tuple[float, float, float] = (0.5, 0.04, 0.84)

    @property
    def least_similarity(self) -> float:
        """Below this a pair merges only by its anchors or its key."""
        return min(self.high_similarity, self.recent_similarity, self.names_similarity, self.name_similarity, self.mixed_similarity, self.family_similarity)


def named_tokens(c: Column, stop: Sequence[str]) -> Column:
    """Words that begin with a capital, in ASCII letters, normalised and without stop words; distinct, in order."""
    whole = F.filter(F.split(c, r"[^\p{L}\p{N}&.\-]+"), lambda w: w.rlike(r"^[A-Z][A-Za-z0-9&.\-]+$"))
    return F.array_distinct(F.filter(F.transform(whole, text.plain_words), lambda w: (w != "") & ~w.isin(list(stop))))


def features(reports: DataFrame, title: str, summary: str, r: StoryRules) -> DataFrame:
    """Adds key, words, names, anchors, actions and roundup of each report; null texts count as ''."""
    t, s = text.missing_as_empty(F.col(title)), text.missing_as_empty(F.col(summary))
    both = F.concat(t, F.lit(" "), s)
    out = reports.withColumn("_w", F.explode(F.array(F.struct(text.word_array(both, 2, r.stop).alias("words"), text.word_array(t, 2, r.stop).alias("title_words"), named_tokens(both, [*r.stop, *r.generic]).alias("names")))))
    out = out.withColumns({"words": F.col("_w.words"), "names": F.col("_w.names"), "key": text.slug(F.col("_w.title_words"))})
    known = F.array_intersect("words", F.array(*map(F.lit, r.anchors)).cast("array<string>"))
    anchors = F.array_union(known, F.filter("names", lambda w: F.length(w) >= 3))
    actions = F.filter(F.array(*[F.when(F.arrays_overlap(F.col("_w.title_words"), F.array(*map(F.lit, words))), name) for name, words in r.families.items()] or [F.lit(None).cast("string")]), lambda x: x.isNotNull())
    roundup = F.lit(False)
    for p in r.roundups:
        roundup = roundup | text.plain_words(t).contains(p)
    return out.withColumns({"anchors": anchors, "actions": actions, "roundup": roundup}).drop("_w")


_MEASURES = "a bigint, b bigint, sim double, words int, names int, anchors int, firm int, gap double, actions int, both boolean, shared boolean, roundup boolean, key boolean, source boolean, family boolean, follows boolean"


class _Held:
    """Reports of one group in the order of time: what the sweep compares at once, and the sets that judge the rest."""

    sets = ("words", "names", "firm", "loose", "actions", "shared")
    flat = ("node", "t0", "t1", "before", "here")
    same = ("key", "source", "family", "roundup")

    def __init__(self, batch: pa.RecordBatch):
        self.cols = [batch[c].to_numpy(zero_copy_only=False) for c in self.flat]
        for c, size in (("words", 8), ("firm", 4)):
            self.cols += [x if x.ndim == 1 else x.T for x in hash_bits(batch[c], size)]
        rows = [[*map(frozenset, batch[c].to_pylist())] for c in self.sets] + [batch[c].to_pylist() for c in self.same]
        self.cols.append(np.fromiter(zip(*rows), object, batch.num_rows))

    def take(self, at) -> _Held:
        out = object.__new__(_Held)
        out.cols = [c[at] for c in self.cols]
        return out

    def after(self, held: _Held | None) -> _Held:
        out = object.__new__(_Held)
        out.cols = self.cols if held is None else [np.concatenate(c) for c in zip(held.cols, self.cols)]
        return out


def _sweep(width: int, least: float, count: int, block: int = 256):
    """Compares reports that come sorted by cell, t0 and node with the earlier ones of their cell within `width`.

    The bits that two sets share, and the members of the smaller set that have no bit of their own, are the most they
    may have in common; pairs that could reach `least` or `count` firm anchors by that are judged by their sets.
    Only reports within reach of the last one are held.
    """

    def common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
        met = np.zeros((len(x[0]), len(y[0])), np.int32)
        for i in range(x[0].shape[1]):
            met += np.bitwise_count(x[0][:, i][:, None] & y[0][:, i][None, :])
        return met + np.minimum(x[1][:, None], y[1][None, :])

    def pairs(late: _Held, every: _Held, start: int) -> Iterator[tuple]:
        ln, l0, _, lb, here = late.cols[:5]
        en, e0, e1 = every.cols[:3]
        reach = (l0[:, None] - e1[None, :] <= width) & here[:, None] & (np.arange(len(en))[None, :] < start + np.arange(len(ln))[:, None])
        need = np.maximum(1, (late.cols[7][:, None] + every.cols[7][None, :]) * (least / (1 + least)) - 1e-6)
        may = (common(late.cols[5:8], every.cols[5:8]) >= need) | (common(late.cols[8:11], every.cols[8:11]) >= count) | (lb[:, None] == en[None, :])
        for j, i in zip(*np.nonzero(may & reach)):
            x, y = every.cols[11][i], late.cols[11][j]
            words = len(x[0] & y[0])
            union = len(x[0]) + len(y[0]) - words
            sim, firm, follows = words / union if union else 0.0, len(x[2] & y[2]), bool(lb[j] == en[i])
            if sim >= least - 1e-9 or firm >= count or follows:
                a, b = int(en[i]), int(ln[j])
                yield (
                    min(a, b), max(a, b), sim, words, len(x[1] & y[1]), firm + len(x[3] & y[3]), firm, max(0, int(l0[j]) - int(e1[i])) / 3_600_000_000, len(x[4] & y[4]), bool((x[2] or x[3]) and (y[2] or y[3])),
                    not x[5].isdisjoint(y[5]), x[9] or y[9], x[6] == y[6], x[7] is not None and x[7] == y[7], x[8] == y[8], follows,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        fields = [(n, kinds[t]) for n, t in map(str.split, _MEASURES.split(", "))]
        held, cell = None, None
        for batch in batches:
            cells = batch["cell"].to_numpy()
            cuts = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1), len(cells)] if len(cells) else [0]
            rows = _Held(batch)
            for begin, end in zip(cuts, cuts[1:]):
                if cells[begin] != cell:
                    held, cell = None, cells[begin]
                for at in range(begin, end, block):
                    late = rows.take(slice(at, min(at + block, end)))
                    start = 0 if held is None else len(held.cols[0])
                    every = late.after(held)
                    found = [*pairs(late, every, start)]
                    held = every.take(every.cols[2] + width >= late.cols[1][-1])
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*found), fields)], names=[n for n, _ in fields])

    return run


def event_key(title_words: Column) -> Column:
    return F.xxhash64(text.slug(title_words))


def followed(rows: DataFrame, hours: float) -> DataFrame:
    """Adds before to rows(node, gh, key, t0, t1): the one before of its group and key, where it is within `hours`."""
    order = W.partitionBy("gh", "key").orderBy("t0", "node")
    before = F.when(F.col("t0") - F.lag("t1").over(order) <= int(hours * 3_600_000_000), F.lag("node").over(order))
    return rows.withColumn("before", F.coalesce(before, F.lit(-(2**63))))


def compared(f: DataFrame, r: StoryRules) -> DataFrame:
    """What the cascade needs of each pair a < b of reports f(node, g, t0, t1, source, source_group, features) of one group within `hours` that a rule may merge.

    Lossless. A pair merges by its similarity, by `anchor_count` anchors that are not broad, or by its key; then
    reports of one key are linked in the order of time, each with the one before, which is in the same event as
    all earlier ones within reach. A report goes, as hashes of its words, to the cell of its group and its four
    spells of `hours`, and to the next cells that its reach extends to; there it is compared with the
    earlier ones within reach by a sweep. So pairs never carry texts, and work grows with the time covered,
    not its square. Where f brings `before`, as `followed` finds it, only the way to the cells shuffles features.
    """
    width = int(r.hours * 3_600_000_000)
    hashed = lambda c: F.transform(c, lambda w: F.xxhash64(w))
    literal = lambda words: F.array(*map(F.lit, words)).cast("array<string>")
    cell = lambda c: F.floor(c / (4 * max(width, 1)))
    own = f.select(
        "node", "t0", "t1", F.xxhash64("g").alias("gh"), hashed(F.col("words")).alias("words"), hashed(F.col("names")).alias("names"),
        hashed(F.array_except("anchors", literal(r.broad))).alias("firm"), hashed(F.array_intersect("anchors", literal(r.broad))).alias("loose"), hashed(F.col("actions")).alias("actions"),
        hashed(F.array_intersect("words", literal(r.shared))).alias("shared"), F.xxhash64("key").alias("key"), F.when(F.col("source").isNotNull(), F.xxhash64("source")).alias("source"),
        F.xxhash64("source_group").alias("family"), F.col("roundup"), *(c for c in f.columns if c == "before"),
    )
    own = own if "before" in f.columns else followed(own, r.hours)  # texts are hashed before they are shuffled
    own = own.withColumn("at", F.explode(F.sequence(cell(F.col("t0")), cell(F.col("t1") + width))))
    rows = own.withColumn("here", F.col("at") == cell(F.col("t0"))).withColumn("cell", F.xxhash64("gh", "at")).drop("gh", "at")
    return rows.repartition("cell").sortWithinPartitions("cell", "t0", "node").mapInArrow(_sweep(width, r.least_similarity, r.anchor_count), _MEASURES)


def decisions(f: DataFrame, r: StoryRules) -> DataFrame:
    """(a, b, merges, reason, confidence) of pairs of reports f(node, g, t0, t1, source, source_group, features).

    Pairs are those that are similar enough for a rule, share enough firm anchors or follow each other under one key.
    """
    p = compared(f, r)
    sim, gap, names = F.col("sim"), F.col("gap"), F.col("names")
    words, anchors, firm, both = F.col("words"), F.col("anchors"), F.col("firm"), F.col("both")
    firmly = both & (firm >= r.anchor_count) & (words >= r.anchor_words) & (gap <= r.anchor_hours)
    sure = lambda c, n: thousandths(F.least(F.lit(c[2]), F.lit(c[0]) + sim + n * F.lit(c[1])))
    flat = thousandths(sim)
    cascade = [
        ("outside_time_window", gap > r.hours, False, 0.0),
        ("same_event_key", F.col("key"), True, 1.0),
        ("generic_roundup_guard", F.col("source") & F.col("roundup") & (sim < r.roundup_similarity), False, 0.0),
        ("distinct_anchor_sets", both & (anchors == 0) & (sim < r.distinct_similarity), False, 0.0),
        ("broad_anchor_only", both & (anchors > 0) & (firm == 0) & (sim < r.broad_similarity) & ~F.col("shared"), False, 0.0),
        ("meaningful_anchor_without_action", firmly & (sim < r.action_below) & (F.col("actions") == 0), False, 0.0),
        ("meaningful_anchor_overlap", firmly, True, sure(r.anchor_confidence, firm)),
        ("high_token_similarity", sim >= r.high_similarity, True, flat),
        ("shared_tokens_recent", (words >= r.recent_words) & (sim >= r.recent_similarity) & (gap <= r.recent_hours), True, sure(r.recent_confidence, words)),
        ("entity_overlap", (names >= r.names_count) & (sim >= r.names_similarity), True, sure(r.names_confidence, names)),
        ("entity_similarity_overlap", (names >= 1) & (sim >= r.name_similarity), True, sure(r.name_confidence, names)),
        ("entities_and_recent_tokens", (names >= r.names_count) & (words >= r.recent_words) & (sim >= r.mixed_similarity) & (gap <= r.recent_hours), True, sure(r.mixed_confidence, names)),
        ("same_source_family_similarity", F.col("family") & (sim >= r.family_similarity), True, flat),
    ]
    return rel.decided(p, cascade, "insufficient_overlap").select("a", "b", "merges", "reason", "confidence")


@dataclass(frozen=True)
class MergeLimits:
    """When two reports of a collection are one event by address, title, names and words."""

    # Hours, similarities, counts, then confidences.
    hours: float = 48
    same_source_address: float = 0.8
    same_source_title: float = 0.9
    title: float = 0.88
    same_host_title: float = 0.78
    names: int = 2
    names_overlap: float = 0.5
    overlap: float = 0.72
    overlap_title: float = 0.55


def _same(c: str) -> Column:
    return F.coalesce(F.col(f"p.{c}") == F.col(f"q.{c}"), F.lit(False))


def met_by_key(reports: DataFrame, m: MergeLimits = MergeLimits()) -> tuple[DataFrame, DataFrame]:
    """(alike, unlike) pairs a < b of reports(id, source, url, plain, at), each once: alike(a, b, l, r) of one plain title, unlike(a, b) of one address and unlike ones.

    Two empty plain titles are alike; they are paired where a rule asks for no more, that is at one address,
    of one source or within `hours`. All pairs of a key are listed, since a link to the first would not tell the rule of
    the others, and the first may be the one that does not merge. Rows are hashes, and keys that stand alone are left out.
    """
    width = int(m.hours * 3_600_000_000)
    hashed = lambda c: F.when(F.col(c) != "", F.xxhash64(c)).alias(c)
    slim = reports.select("id", F.when(F.col("source").isNotNull(), F.xxhash64("source")).alias("source"), hashed("url"), hashed("plain"), F.unix_micros("at").alias("t"))
    key = lambda i, c: F.struct(F.lit(i).alias("i"), c.alias("k"))
    keys = F.array(key(0, F.col("url")), key(1, F.col("plain")), key(2, F.when(F.col("plain").isNull(), F.col("source"))))
    each = slim.withColumn("key", F.explode(F.filter(keys, lambda k: k["k"].isNotNull())))
    each = each.join(each.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "key", "left_semi")
    p, q = each.alias("p"), each.alias("q")
    met = p.join(q, F.col("p.key") == F.col("q.key")).filter((F.col("p.id") < F.col("q.id")) & ((F.col("p.key.i") == 0) | ~_same("url"))).drop("key")
    # empty titles of two sources within reach: the later one in its spell of `hours`, the earlier one in its own and the next
    none, spell = slim.filter("plain is null and t is not null"), F.floor(F.col("t") / max(width, 1))
    p, q = none.withColumn("k", F.explode(F.array(spell, spell + 1))).alias("p"), none.withColumn("k", spell).alias("q")
    before = (F.col("p.t") < F.col("q.t")) | (F.col("p.t") == F.col("q.t")) & (F.col("p.id") < F.col("q.id"))
    near = p.join(q, F.col("p.k") == F.col("q.k")).filter(before & (F.col("q.t") - F.col("p.t") <= width) & ~_same("source") & ~_same("url")).drop("k")
    one = F.col("p.plain").eqNullSafe(F.col("q.plain"))
    text_ = lambda n, c: F.coalesce(F.col(f"{n}.{c}").cast("string"), F.lit("")).alias(c)
    nothing = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
    side = lambda n: F.struct(F.col(f"{n}.source").cast("string").alias("source"), text_(n, "url"), text_(n, "plain"), F.timestamp_micros(f"{n}.t").alias("at"), *nothing("string", "host", "tag"), *nothing("array<string>", "words", "names"))
    pair = [F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b")]
    alike = [rows.filter(one).select(*pair, side("p").alias("l"), side("q").alias("r")) for rows in (met, near)]
    return alike[0].union(alike[1]), met.filter(~one).select(*pair)


def may_merge(reports: DataFrame, m: MergeLimits = MergeLimits()) -> DataFrame:
    """(a, b), a < b, of reports(id, source, host, plain, words, names, tag, at) that a rule of `merges` other than one address or title may merge.

    Loses no pair, and may give one twice or one that no rule merges. Titles meet by the pairs of characters they
    share: those of one source by their length, which bounds the ratio, others in the order of time.
    Shared names and words are looked for among the reports of one tag.
    """
    width = int(m.hours * 3_600_000_000)
    own = F.when(F.col("source").isNotNull(), F.xxhash64("source"))
    every = reports.withColumns({"node": F.col("id"), "own": F.coalesce(own, F.col("id")), "t0": F.unix_micros("at"), "t1": F.unix_micros("at")})
    timed = every.filter("t0 is not null")
    place = ["node", "gh", "t0", "t1", "own"]

    def texts(rows: DataFrame, reach: int, least: float) -> DataFrame:
        return near_sets(rows.filter("plain <> ''").withColumn("g", gram_bits("plain")).select(*(c for c in place if c in rows.columns), "g.*"), width=reach, hot=50_000, fold=4, **like_texts(least))

    titles = texts(timed.withColumn("gh", F.lit(0).cast("bigint")), width, m.title)
    hosts = timed.filter("host <> ''").groupBy("host").agg(F.min("own").alias("x"), F.max("own").alias("y")).filter("x <> y").select("host")
    hosted = texts(timed.join(hosts, "host", "left_semi").withColumn("gh", F.xxhash64("host")), width, m.same_host_title)
    # titles of one source, each once; a ratio bounds the quotient of the lengths
    sourced = reports.filter("source is not null and plain <> ''").select("id", "plain", F.xxhash64("source").alias("gh"), F.xxhash64("source", "plain").alias("node"))
    length = F.floor(F.log(F.length("plain")) * 1_000_000)
    once = sourced.groupBy("gh", "node").agg(F.first("plain").alias("plain")).withColumns({"t0": length, "t1": length})
    like = texts(once, int(math.log((2 - m.same_source_title) / m.same_source_title) * 1_000_000) + 2, m.same_source_title)
    members = sourced.select("id", "node")
    like = like.join(members.select(F.col("node").alias("a"), F.col("id").alias("x")), "a").join(members.select(F.col("node").alias("b"), F.col("id").alias("y")), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    tagged = timed.filter("tag <> ''").withColumn("gh", F.xxhash64("tag"))
    hashed = lambda c: F.array_distinct(F.transform(c, lambda w: F.xxhash64(w)))
    named = near_sets(tagged.filter(F.size("names") > 0).select(*place, hashed(F.transform("names", F.lower)).alias("h")), 0.0, width, plus=m.names)
    worded = near_sets(tagged.filter(F.size("words") > 0).select(*place, hashed(F.col("words")).alias("h")), m.overlap, width, smaller=True, fold=4)
    return titles.union(hosted).union(like).union(named).union(worded)


def merges(pairs: DataFrame, m: MergeLimits = MergeLimits(), sim: Column | None = None) -> DataFrame:
    """Adds merges, reason and confidence to pairs with the structs `l` and `r` of two reports; `sim` is the likeness of their titles where it is known.

    A report has source, url, host, plain (its title for comparison), words, names, tag and at (a timestamp).
    The rules in their order: one address (of one source only with like titles), one plain title, one
    source with nearly equal titles, then, within `hours`, like titles, rather like ones on one host, shared
    names with shared words and one tag, or many shared words. A missing time is no time within reach.
    """
    x, y = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    gap = F.coalesce(F.abs(F.unix_micros(x("at")) - F.unix_micros(y("at"))) / 3_600_000_000, F.lit(999.0))
    p = pairs.withColumn("_f", F.explode(F.array(F.struct(
        (text.sequence_ratio(x("plain"), y("plain")) if sim is None else sim).alias("sim"), gap.alias("gap"), text.overlap(x("words"), y("words")).alias("shared"),
        F.size(F.array_intersect(F.transform(x("names"), F.lower), F.transform(y("names"), F.lower))).alias("names"),
        ((x("tag") != "") & (x("tag") == y("tag"))).alias("tag"), (x("source") == y("source")).alias("source"), ((x("url") != "") & (x("url") == y("url"))).alias("url"), ((x("host") != "") & (x("host") == y("host"))).alias("host"),
    ))))
    f = lambda c: F.coalesce(F.col(f"_f.{c}"), F.lit(False)) if c in ("tag", "source", "url", "host") else F.col(f"_f.{c}")
    cascade = [
        ("unlike titles at one address", f("url") & f("source") & (f("sim") < m.same_source_address), False, 0.0),
        ("same address", f("url"), True, 1.0),
        ("same title", (x("plain") != "") & (x("plain") == y("plain")), True, 0.98),
        ("same source, nearly the same title", f("source") & (f("sim") >= m.same_source_title), True, thousandths(f("sim"))),
        ("same source", f("source"), False, 0.0),
        ("too far apart", f("gap") > m.hours, False, 0.0),
        ("like titles", f("sim") >= m.title, True, thousandths(f("sim"))),
        ("like titles on one host", f("host") & (f("sim") >= m.same_host_title), True, thousandths(f("sim"))),
        ("names, words and section", (f("names") >= m.names) & (f("shared") >= m.names_overlap) & f("tag"), True, thousandths(F.least(F.lit(0.9), 0.58 + f("names") * 0.08 + f("shared") * 0.2))),
        ("many words and section", (f("shared") >= m.overlap) & (f("sim") >= m.overlap_title) & f("tag"), True, thousandths(F.least(F.lit(0.86), f("shared")))),
    ]
    return rel.decided(p, cascade, "too little in common").drop("_f")


def _keep(top: int):
    """Streams (id, source, place, url, key, taken, top_k) sorted by source and order: keeps a row unless its address or title key was kept before, `top` rows of a source."""
    def run(batches):
        source, urls, keys = object(), set(), set()
        n = 0
        for batch in batches:
            keep = []
            for s, u, k, taken, limit in zip(*(batch.column(i).to_pylist() for i in (1, 3, 4, 5, 6))):
                if s != source:
                    source, urls, keys, n = s, set(), set(), 0
                good = not taken and n < (limit if limit is not None else top) and not (u and u in urls) and not (k and k in keys)
                if good:  # at most the source's limit of addresses and titles is held
                    n += 1
                    urls.add(u)
                    keys.add(k)
                keep.append(good)
            out = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([out.column(i) for i in (0, 1, 2, 3)], names=["id", "source", "place", "url"])

    return run


def kept_candidates(items: DataFrame, limits: DataFrame, id_col: str, source: str, url: Column, key: Column, order: Sequence[Column], top: int) -> DataFrame:
    """(id) of the items that are kept: sources in the order of their first item, each source's items in `order`.

    An item is kept unless its address has been kept before, of any source, or its title key of the same
    source, or its source has its limit of kept items: limits(source, top_k), else `top`. Each source is a
    stream in its order that holds no more than what it keeps. Addresses kept by earlier sources come as a
    table of at most the limits' rows; since sources depend on earlier ones only, rounds end when nothing
    changes. Null and '' addresses and keys clash with nothing.
    """
    own = items.select(F.col(id_col).alias("id"), F.col(source).alias("source"), url.alias("url"), key.alias("key"), F.struct(*order, F.col(id_col)).alias("o"))
    places = own.groupBy("source").agg(F.min("id").alias("place"))
    own = own.join(places, "source").join(limits.select("source", "top_k").dropDuplicates(["source"]), "source", "left")
    own = pin(own.select("id", "source", "place", "url", "key", "top_k", "o"))
    kept = None
    while True:
        if kept is None:
            x = own.withColumn("taken", F.lit(False))
        else:
            first = kept.filter("url <> ''").groupBy("url").agg(F.min("place").alias("by"))
            x = own.join(first, "url", "left").withColumn("taken", F.coalesce(F.col("by") < F.col("place"), F.lit(False)))
        x = x.select("id", "source", "place", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("key", F.lit("")).alias("key"), "taken", "top_k", "o")
        now = pin(x.repartition("source").sortWithinPartitions("source", "o").drop("o").mapInArrow(_keep(top), "id bigint, source string, place bigint, url string"))
        if kept is not None and now.select("id").exceptAll(kept.select("id")).isEmpty() and kept.select("id").exceptAll(now.select("id")).isEmpty():
            return now.select(F.col("id").alias(id_col))
        kept = now
