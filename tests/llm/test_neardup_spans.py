import random

from newsloom.llm import neardup, spans


def _texts(n, seed, vocab=400):
    random.seed(seed)
    words = ["".join(random.choice("abcdefghijklmnoprstuvw") for _ in range(random.randint(3, 9))) for _ in range(vocab)]
    out = []
    for _ in range(n):
        base = [random.choice(words) for _ in range(random.randint(18, 40))]
        out.append(" ".join(base))
        for _ in range(random.randint(0, 3)):
            copy = list(base)
            for _ in range(random.randint(0, 4)):
                k = random.randrange(len(copy))
                random.choice([lambda: copy.pop(k), lambda: copy.insert(k, random.choice(words)), lambda: copy.__setitem__(k, random.choice(words))])()
            out.append(" ".join(copy))
    return out


def _groups(rows, threshold, least):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    grams = {i: {t[k : k + 3] for k in range(len(t) - 2)} for i, t in rows if t and len(t) >= least}
    ids = sorted(grams)
    for a in ids:
        for b in ids:
            if a < b and len(grams[a] & grams[b]) >= threshold * len(grams[a] | grams[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_groups_match_brute_force(spark):
    rows = list(enumerate(_texts(60, 4)))
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [(2000, None), (2001, ""), (2002, "short"), (2003, "x" * 30000), (2004, "x" * 30000)]
    df = spark.createDataFrame([(i, t, "c", "c") for i, t in rows], "id bigint, story string, doc string, k1 string")
    got = {r["id"]: r["group_id"] for r in neardup.near_duplicate_groups(df, "id", "story").collect()}
    assert got == _groups(rows, 0.65, 80)
    pairs = neardup.pairs_within(neardup.near_duplicate_groups(df, "id", "story"), "id").count()
    sizes = {}
    for g in got.values():
        sizes[g] = sizes.get(g, 0) + 1
    assert pairs == sum(n * (n - 1) // 2 for n in sizes.values())
    assert neardup.near_duplicate_groups(df.limit(0), "id", "story").count() == 0


def test_long_lists_spread_over_blocks(spark):
    random.seed(8)
    base = _texts(1, 5)[0].split()
    rows = []
    for i in range(150):
        copy = list(base)
        copy[random.randrange(len(copy))] = f"word{i}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc bigint, text string").repartition(1)
    pairs = lambda **k: {tuple(r) for r in neardup.candidate_pairs(df, neardup.Signature(**k)).collect()}
    whole = pairs()
    assert len(whole) > 0.9 * 150 * 149 / 2
    assert pairs(block=16) == whole == pairs(block=1000)


def test_pairs_below_the_match_threshold_are_dropped(spark):
    rows = [(i, t) for i, t in enumerate(dict.fromkeys(_texts(30, 9)))]
    df = spark.createDataFrame(rows, "doc bigint, text string")
    count = lambda m: {tuple(r) for r in neardup.candidate_pairs(df, neardup.Signature(match=m)).collect()}
    one, two, four = count(1), count(2), count(4)
    assert four <= two <= one and len(four) < len(one)


def test_odds_of_finding_a_link():
    import numpy as np

    s = neardup.Signature()
    rng = np.random.default_rng(s.seed + 1)
    chosen = [rng.choice(s.minima, s.width, replace=False) for _ in range(s.coordinates)]
    equal = np.random.default_rng(1).random((20000, s.minima))
    for similarity, odds in ((0.65, 0.95), (0.7, 0.985), (0.75, 0.995)):
        met = sum((equal[:, c] < similarity).all(axis=1).astype(int) for c in chosen)
        assert (met >= s.match).mean() > odds


def test_unlike_texts_leave_few_rows_in_the_merge():
    """Collisions of unlike texts grow with the square of the texts, so nearly all must end before the shuffle; lists that span batches are whole."""
    import numpy as np
    import pyarrow as pa

    random.seed(12)
    words = ["".join(random.choice("aeiou" if i % 2 else "bdklmnrst") for i in range(random.randint(4, 8))) for _ in range(250)]
    texts = [" ".join(random.choice(words) for _ in range(35)) for _ in range(3000)]
    s = neardup.Signature()
    post = pa.Table.from_batches(neardup._postings(s)(iter([pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc", "text"])])))
    post = post.take(pa.array(np.argsort(post["key"].to_numpy(), kind="stable"))).combine_chunks()
    size = np.unique(post["key"].to_numpy(), return_counts=True)[1].astype(np.int64)
    rows = lambda n: sorted((r["a"], r["b"], r["met"]) for b in neardup._merge(s)(iter(post.to_batches(max_chunksize=n))) for r in b.to_pylist() if r["a"] is not None)
    found = rows(10_000)
    assert found == rows(777)
    assert len(found) < 0.01 * (size * (size - 1) // 2).sum()


def test_story_text(spark):
    df = spark.createDataFrame([("Ａ—b's  “X”", None), (None, "é_1")], "t string, s string")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(neardup.story_text(F.col("t"), F.col("s"))).collect()] == ["a b s x", "é 1"]


def _sharing(rows, least):
    seen = {}
    for i, t in rows:
        for k in range(len(t or "") - least + 1):
            seen.setdefault(t[k : k + least], set()).add(i)
    return {(a, b) for m in seen.values() for a in m for b in m if a < b}


def _documents():
    random.seed(9)
    rnd = lambda n: "".join(random.choice("abcdef ghij世界é") for _ in range(n))
    hot = rnd(299)  # just too short to count, in many documents
    shared = [rnd(300), rnd(301), rnd(420), rnd(900)]
    rows = []
    for i in range(150):
        parts = [rnd(random.randint(50, 400))]
        if i % 2:
            parts.append(hot)
            parts.append(rnd(5))
        if i % 5 == 0:
            parts.append(shared[(i // 5) % 4])
        parts.append(rnd(random.randint(0, 300)))
        rows.append((i, "".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, None), (503, ""), (504, "z" * 5000), (505, "z" * 4000), (506, rnd(200)), (507, rnd(200))]
    return rows


def test_spans_match_brute_force(spark):
    rows = _documents()
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id bigint, text string, doc string, h0 int").repartition(5)
    want = _sharing(rows, 300)
    got = {(r["doc_id_a"], r["doc_id_b"]) for r in spans.sharing_documents(df, "doc_id", "text").collect()}
    assert got == want
    narrow = spans.Doubling(run_limit=4)  # every run of five documents or more takes the other way
    assert {(r["doc_id_a"], r["doc_id_b"]) for r in spans.sharing_documents(df, "doc_id", "text", narrow).collect()} == want
    three = spans.Doubling(min_chars=300, first=64)
    assert {(r["doc_id_a"], r["doc_id_b"]) for r in spans.sharing_documents(df, "doc_id", "text", three).collect()} == want
    assert spans.sharing_documents(df.limit(0), "doc_id", "text").count() == 0
    assert spans.sharing_documents(df.union(df), "doc_id", "text").count() == len(want)


def test_shared_amount(spark):
    rows = _documents()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = {}
    for i, t in rows:
        for k in range(len(t or "") - 299):
            seen.setdefault(t[k : k + 300], set()).add(i)
    for r in spans.shared_amount(df, "doc_id", "text").collect():
        t = dict(rows)[r["doc_id"]] or ""
        cover = set()
        for k in range(len(t) - 299):
            if len(seen[t[k : k + 300]]) > 1:
                cover |= set(range(k, k + 300))
        assert (r["n_chars"], r["shared_chars"]) == (len(t), len(cover)), r["doc_id"]


def test_runs_across_batches():
    import pyarrow as pa

    random.seed(4)
    rows = sorted((random.randint(0, 12), random.randint(0, 5)) for _ in range(120)) + [(99, 4)]
    for size in (1, 2, 3, 7, 200):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array([d for _, d in p]), pa.array([k for k, _ in p]), pa.array([int(k == 99) for k, _ in p], pa.int8()), pa.array([0] * len(p), pa.int8())], names=["doc", "h0", "known", "salt"]) for p in parts]
        got = sorted((k, d) for b in spans._repeated(0)(iter(batches)) for d, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        docs = {k: {d for j, d in rows if j == k} for k, _ in rows}
        assert got == [(k, d) for k, d in rows if len(docs[k]) > 1 or k == 99]
        out = {tuple(c[i].as_py() for c in b.columns) for b in spans._pair_up(1)(iter(batches)) for i in range(b.num_rows)}
        assert out == {(a, b) for m in docs.values() for a in m for b in m if a < b}


def test_hot_windows_are_salted():
    import numpy as np

    cols = np.array([[1, 2, 3, 4, 4], [7, 7, 7, 8, 8], [70, 70, 71, 80, 81]], np.uint64)
    doc, h, _, known, salt = spans._salted(cols)
    assert known.tolist() == [1, 1, 1, 0, 0] and salt.tolist()[0] == 0 and all(salt[1:3] > 0) and salt.tolist()[3:] == [0, 0]
