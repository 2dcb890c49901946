import os
import random
import re

import pytest

from newsloom.llm import leakage, mixing

WORD = re.compile(r"[^\W_]+")


def _windows(text, n):
    w = [x.lower() for x in WORD.findall(text or "")]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def _setup():
    random.seed(5)
    common = [f"{c}{v}{d}" for c in "bdfgk" for v in "aeiou" for d in "lmnr"]
    sentence = lambda n: " ".join(random.choice(common) for _ in range(n))
    items = [(i, f"{sentence(6).capitalize()} Zorvik {random.randint(2, 90)} units {sentence(9)}. {sentence(8)}") for i in range(40)] + [(90, None), (91, "too short"), (92, "")]
    docs = []
    for i in range(120):
        parts = [sentence(random.randint(5, 40))]
        if i % 3 == 0:
            w = WORD.findall(items[i % 40][1])
            k = random.choice([10, 11, 12, 14, 20])
            s = random.randint(0, max(0, len(w) - k))
            piece = " ".join(w[s : s + k])
            parts.append(piece.upper() if i % 2 else piece)
        parts.append(sentence(random.randint(0, 30)))
        docs.append((i, " ".join(parts)))
    docs += [(500, None), (501, ""), (502, (items[0][1] + " ") * 300)]
    return docs, items


@pytest.mark.parametrize("longs", [1 << 18, 1])
def test_exact_leaks_match_brute_force(spark, longs):
    docs, items = _setup()
    d = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id bigint, text string, item string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, exact int")
    found = leakage.leaked_windows(d.union(d), b, "doc_id", "item_id", filter_longs=longs)
    got = {(r["doc"], r["item"]) for r in found.filter("exact > 0").collect()}
    assert got == {(i, j) for i, t in docs for j, u in items if _windows(t, 12) & _windows(u, 12)}
    assert leakage.leaked_windows(d, b.limit(0), "doc_id", "item_id").count() == 0
    assert leakage.leaked_windows(d.limit(0), b, "doc_id", "item_id").count() == 0
    assert leakage.leaked_items(found).count() > 0


def test_reparameterised_item(spark):
    item = "In spring the city of Moskel bought 12 trains from the firm Barvo and sold 7 old trains to Moskel again"
    same = item.replace("Moskel", "Trenga").replace("12", "48").replace("Barvo", "Kirsun").replace(" 7 ", " 9 ")
    mixed = item.replace("Moskel", "Trenga", 1).replace("12", "48")  # one slot filled in two ways
    d = spark.createDataFrame([(1, same), (2, mixed), (3, "Nothing of this stands here " * 5)], "doc_id bigint, text string")
    got = {r["doc"]: (r["exact"], r["changed"]) for r in leakage.leaked_windows(d, spark.createDataFrame([(1, item)], "item_id bigint, text string"), "doc_id", "item_id").collect()}
    assert got[1][0] == 0 and got[1][1] > 0 and 3 not in got
    assert got.get(2, (0, 0))[1] < got[1][1]


needs_tokenizer = pytest.mark.skipif(not os.path.exists(mixing.TOKENIZER), reason="no tokenizer file")


@needs_tokenizer
def test_mixture_meets_shares_and_caps(spark):
    random.seed(6)
    rows = [(i, "word " * random.randint(20, 200), "big" if i % 3 else "mid", "c") for i in range(3000)] + [(9000 + i, "word " * 100, "tiny", "c") for i in range(12)] + [(9500, None, "big", "c"), (9501, "", "big", "c"), (9502, "x", None, "c"), (None, "x", "big", "c"), (9503, "word " * 60000, "big", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, rank string")
    docs = docs.union(docs.filter("doc_id = 9000"))
    targets = spark.createDataFrame([("big", 0.5, 2), ("mid", 0.3, 3), ("tiny", 0.1, 4), ("gone", 0.1, 2), (None, 0.1, 2), ("zero", 0.0, 1)], "source string, target_share double, max_repeats int")
    mixed, goals = mixing.mixture(docs, targets, total_tokens=60_000)
    out = mixed.collect()
    assert len({r["doc_id"] for r in out}) == len(out)
    caps = {"big": 2, "mid": 3, "tiny": 4}
    assert all(1 <= r["copies"] <= caps[r["source"]] for r in out)
    report = {r["source"]: r for r in mixing.shares(mixed, goals).collect()}
    assert report["gone"]["tokens"] == 0 and report["tiny"]["most_repeats"] == 4
    assert abs(report["mid"]["tokens"] / 18_000 - 1) < 0.15 and report["tiny"]["tokens"] == 12 * 4 * _tokens("word " * 100)
    again, _ = mixing.mixture(docs, targets, total_tokens=60_000)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in out}
    assert mixing.mixture(docs.limit(0), targets)[0].count() == 0


def _tokens(text):
    return len(mixing._encoding(mixing.TOKENIZER).encode_ordinary(text))


@needs_tokenizer
def test_fixed_size_and_inclusion_odds(spark):
    docs = spark.createDataFrame([(i, "word " * (10 if i < 500 else 90), "s") for i in range(1000)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int")
    total = sum(_tokens("word " * (10 if i < 500 else 90)) for i in range(1000))
    got = [mixing.mixture(docs, targets, total_tokens=total // 4, length_power=0.5, seed=s)[0].select("doc_id").collect() for s in range(4)]
    assert len({len(x) for x in got}) == 1  # the same number of documents whatever the seed
    assert len({frozenset(r[0] for r in x) for x in got}) == 4
    long_share = sum(r[0] >= 500 for x in got for r in x) / sum(map(len, got))
    assert abs(long_share - 0.75) < 0.05  # odds 3 : 1 by the square root of the length
