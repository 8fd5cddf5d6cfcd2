import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from seismiq.llm import simhash


def brute(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64))


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, d in enumerate(ids):
        low.setdefault(root(i), []).append(d)
    return [min([d for d in low[root(i)] if d is not None], default=None) for i in range(len(fps))]


def test_fingerprint_words():
    for text in ("", " \t\n", "one", "One TWO three", "a b c d e", "É\x0bé  x\ry\x0cz", "same " * 50, "a b c"):
        assert simhash.simhash(text.encode()) == brute(text)


def test_every_pair_within_four_bits_shares_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 600, dtype=np.uint64)
    b = a.copy()
    for i in range(len(a)):
        for bit in rng.choice(64, 4, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    for refine in (0, 1, 2):
        (ka, ra), (kb, rb) = simhash._keys(a, 4, refine), simhash._keys(b, 4, refine)
        left, right = [set() for _ in a], [set() for _ in a]
        for sets, keys, rows in ((left, ka, ra), (right, kb, rb)):
            for k, r in zip(keys.tolist(), rows.tolist()):
                sets[r].add(k)
        assert all(x & y for x, y in zip(left, right))


def test_every_word_is_within_three_bits_of_one_anchor():
    _, _, table = simhash._code()
    weights = np.where(table >= 0, np.bitwise_count(table), 99)
    assert (weights.min(1) <= 3).all() and ((weights <= 3).sum(1) == 1).all()


def chained(rng, n):
    """Fingerprints in chains and clumps of small steps."""
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 9])):
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return out[:n]


def test_components_equal_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    fps = chained(rng, 400)
    ids = list(range(1000, 1400))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    for refine in (0, 1):
        monkeypatch.setattr(simhash, "with_fingerprint", lambda d: d.join(
            spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fingerprint long"), "doc_id"))
        docs = spark.createDataFrame([(i, "") for i in ids], "doc_id long, text string")
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, refine=refine).collect()}
        assert [got[i] for i in ids] == brute_components(fps, ids)


def test_dense_group_gives_a_forest():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 1, dtype=np.uint64)[0]
    fps = np.unique(np.array([base ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 63, (1500, 2))], np.uint64))
    links = simhash._forest(fps, 4)
    assert sum(len(a) for a, _ in links) < len(fps)
    seen = {int(fps[0])}
    for a, b in links:
        seen |= set(map(int, a)) | set(map(int, b))
    assert seen == set(map(int, fps))


def test_long_chain_has_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def test_documents_with_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(5, text, 1), (3, text + " more", 2), (9, "", 3), (8, None, 4), (7, "quite another text here", 5), (None, text, 6), (5, text, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(5, 3), (3, 3), (9, 8), (8, 8), (7, 7), (None, 3)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8]
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0
    assert simhash.keep_one(docs.where(F.lit(False))).count() == 0
