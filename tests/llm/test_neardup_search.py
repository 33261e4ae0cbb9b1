import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmill.llm import decontaminate, neardup, search


def brute_classes(docs):
    bags = [neardup.bag(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if neardup.overlap(bags[i], bags[j]) >= neardup.THRESHOLD:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(docs))]


def group(rng, n, edits, words=80):
    """A text and n copies of it, each with its own edits: near the text, not near each other."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(*edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(3)
    texts = group(rng, 60, (1, 4)) + group(rng, 25, (0, 2)) + group(rng, 10, (3, 9)) + ["loop a b c d e " * 40, "loop a b c d e " * 45, "one two", "one two", "One, two!", "one"]
    texts += [f"u{i} " * 3 + f"v{i}" for i in range(10)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute_classes(docs)
    firsts = {}
    for i, c in enumerate(want):
        firsts.setdefault(c, i)
    assert got == {i: firsts[c] for i, c in enumerate(want)}


def test_cross_links_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "BLOCK_CHARS", 3000)
    test_classes_equal_brute_force(spark)


def test_neardup_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "!!", "x"), (None, "a b c d e f", "x"), (5, "a b c d e f", "x")], "doc_id long, text string, node string")
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, 1), (2, 2, 1), (2, 2, 1), (3, 3, 1), (None, 5, 2), (5, 5, 2)], key=str)
    assert neardup.near_duplicates(df.limit(0)).count() == 0
    kept = neardup.stage_neardup(spark, df, "")
    assert kept.columns == df.columns and kept.count() == 4


def test_bag_minhash_is_unbiased():
    rng = np.random.default_rng(0)
    e, w = rng.integers(0, 2**63, 300).astype("u8"), rng.integers(1, 12, 300)
    other = w.copy()
    other[:80] = rng.integers(1, 12, 80)
    a, b = neardup.bag_minhash([(e, w), (e, other)], 8192)
    want = np.minimum(w, other).sum() / np.maximum(w, other).sum()
    assert abs((a == b).mean() - want) < 0.02


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
    got = {r.node[0]: r.component[0] for r in neardup.components(df).collect()}
    assert got == {n: root(n) for n in got} and set(got) == {n for e in edges if e[0] != e[1] for n in e}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=40), st.lists(st.sampled_from("abcdefg"), max_size=40))
def test_elements_give_the_multiset_overlap(x, y):
    h = decontaminate.WordHashes()
    if len(x) < 5 or len(y) < 5:
        return
    a, b = " ".join(x), " ".join(y)
    p, q = set(neardup.elements(a, h).tolist()), set(neardup.elements(b, h).tolist())
    assert abs(len(p & q) / len(p | q) - neardup.overlap(neardup.bag(a), neardup.bag(b))) < 1e-12


def test_search_equals_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"t{int(rng.paretovariate(0.8))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(1000, docs[5][1]), (1001, None), (1002, ""), (1003, "t1 " * 4000)]
    queries = [(q, docs[q][1]) for q in (0, 5, 7)] + [(50, None), (51, "unknownword"), (52, "t1 t1 t2")]
    for blocks in (2_000_000, 10):
        monkeypatch.setattr(search, "BLOCK_TERMS", blocks)
        got = search.top_k(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "query_id long, text string"))
        assert sorted((r.query_id, r["rank"], r.doc_id) for r in got.collect()) == sorted(search.brute_force(docs, queries))


def test_every_query_row_has_its_own_ranks(spark):
    docs = [(i, f"common word{i % 4} word{i}") for i in range(20)]
    asked = [(9, "word3 common"), (9, "word3 common"), (9, "word2")]
    got = search.top_k(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, text string"), 2).collect()
    one, other = ([(9, r, d) for _, r, d in search.brute_force(docs, [(9, q)], 2)] for q in ("word3 common", "word2"))
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in got) == sorted(one + one + other)


def clustered(n=2000):
    """Documents of forty themes, each with words of its own beside common ones."""
    rng = random.Random(4)
    return [(i, " ".join([f"theme{i % 40}"] * 3 + rng.choices([f"x{i % 40}w{j}" for j in range(60)], k=20) + rng.choices([f"c{j}" for j in range(30)], k=10))) for i in range(n)]


def test_blocks_before_the_pivot_are_passed_over(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(search, "FREQUENT", 3)
    docs = clustered()
    rows = [r for b in search._index(iter([pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs])], names=["doc_id", "text"])])) for r in b.to_pylist()]
    shard = search.Shard(rows[0], rows[0]["total_length"] / rows[0]["n_docs"], counting=True)
    hashes = decontaminate.WordHashes()
    asked = [(i, *search._terms(hashes, decontaminate.tokens(docs[i][1]))) for i in range(0, 2000, 50)]
    df = {int(t): int(n) for t, n in zip(shard.terms, np.bincount(shard.key >> 16), strict=True)}
    queries = [(i, t, np.array([math.log(1 + (2000 - df[int(x)] + 0.5) / (df[int(x)] + 0.5)) for x in t]) * c) for i, t, c in asked]
    best = [[] for _ in queries]
    shard.search(queries, best, 10)
    got = [(q[0], r + 1, -i) for q, heap in zip(queries, best, strict=True) for r, (_, i) in enumerate(sorted(heap, reverse=True))]
    assert got == search.brute_force(docs, [docs[i] for i in range(0, 2000, 50)])
    assert shard.passed > 0.5 * (shard.passed + shard.met) and shard.skipped > 0.1 * (shard.skipped + shard.touched), (shard.passed, shard.met, shard.skipped, shard.touched)
    # Thresholds from elsewhere prune more and lose nothing that reaches them.
    floors = np.array([h[0][0] for h in best])
    again, met = [[] for _ in queries], shard.met
    shard.search(queries, again, 10, floors)
    assert [sorted(h) for h in again] == [sorted(h) for h in best] and shard.met - met < met


def test_seeded_shards_return_few_rows(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 50)
    monkeypatch.setattr(search, "SEED_SHARE", 3)
    docs = clustered()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    asked = [docs[i] for i in range(0, 2000, 100)]
    got = search.top_k(df, spark.createDataFrame(asked, "query_id long, text string"))
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in got.collect()) == sorted(search.brute_force(docs, asked))


def test_search_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, text string")
    assert search.top_k(none, asked).count() == 0
    some = spark.createDataFrame([(1, "a"), (None, "a")], "doc_id long, text string")
    assert [r.doc_id for r in search.top_k(some, asked).collect()] == [1]
    assert search.top_k(some, asked.limit(0)).count() == 0


def test_containment_equals_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(25)] + [(90, None), (91, "w1"), (92, "w1 w2 w3")]
    docs = []
    for i in range(60):
        body = rng.choices(words, k=rng.randint(0, 400))
        if i % 2 and (item := items[i % 25][1]):
            part = item.split()
            for _ in range(i % 4):
                part[rng.randrange(len(part))] = "zz"
            at = rng.randrange(len(body) + 1)
            body[at:at] = part
        docs.append((i, " ".join(body).upper() if i % 3 else ", ".join(body)))
    docs += [(100, None), (101, "")]
    want = []
    for d, t in docs:
        for i, q in items:
            n, grams = decontaminate.item_shingles(decontaminate.tokens(q))
            w = decontaminate.tokens(t)
            own = {tuple(w[p : p + n]) for p in range(len(w) - n + 1)} if n else set()
            if grams and len(grams & own) >= 0.8 * len(grams):
                want.append((d, i, len(grams & own), len(grams)))
    for chars in (16_000_000, 300):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
        got = decontaminate.contained_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items + items[:3], "item_id long, text string"))
        assert sorted((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got.collect()) == sorted(want)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 0
