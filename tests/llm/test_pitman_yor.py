import math
import zlib
from collections import Counter

import numpy as np

from seismiq.llm import pitman_yor as py


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def test_base_scores_and_counts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in py.scores(docs).collect()}
    out = {i for i in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    c = Counter(t for i, x in rows.items() if i not in out for t in tokens(x))
    n, v = sum(c.values()), len(c)
    held = base = size = 0
    for i, x in rows.items():
        t = tokens(x)
        want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in out, len(t), sum(w in c for w in t), n)
        assert abs(r["base_score"] - want) < 1e-6 * abs(want)
        if i in out:
            held, base, size = held + r["score"], base + want, size + len(t)
    # perplexity of texts it has not learnt from is below that of the smoothed unigram
    assert 10 ** (-held / size) < 0.95 * 10 ** (-base / size)


def test_seating():
    rng = np.random.default_rng(1)
    c = np.array([0, 1, 2, 5, 50, 5_000, 10**9] * 300)
    t = py.seat(c, np.full(len(c), 2.0), 0.5, rng)
    assert (t[c == 0] == 0).all() and (t[c == 1] == 1).all() and (t <= np.maximum(c, 0)).all() and (t[c > 0] >= 1).all()
    # exact mean for few customers: P(new) at n customers and k tables is a / (a + n - d k)
    mean = {1: 1.0}
    state = {1: 1.0}
    for n in range(1, 5):
        nxt = {}
        for k, p in state.items():
            new = 2.0 / (2.0 + n - 0.5 * k)
            nxt[k + 1] = nxt.get(k + 1, 0) + p * new
            nxt[k] = nxt.get(k, 0) + p * (1 - new)
        state = nxt
        mean[n + 1] = sum(k * p for k, p in state.items())
    assert abs(t[c == 2].mean() - mean[2]) < 0.12 and abs(t[c == 5].mean() - mean[5]) < 0.25
    # block draws agree with one by one seating
    one = []
    for _ in range(300):
        k, n = 1, 1
        for n in range(1, 400):
            k += rng.random() < 3.0 / (3.0 + n - 0.5 * k)
        one.append(k)
    many = py.seat(np.full(300, 400), np.full(300, 3.0), 0.5, rng)
    assert abs(np.mean(one) - many.mean()) < 1.0


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    c = rng.integers(0, 5, (40, py.CONTEXTS))
    t = py.seat(c.ravel(), np.full(c.size, 0.3), py.DISCOUNT, rng).reshape(c.shape)
    t0 = py.seat(t.sum(1), np.full(40, 0.2), py.ROOT_DISCOUNT, rng)
    known = c.sum(1) > 0
    c, t, t0 = c[known], t[known], t0[known]
    totals = py.Totals(c.sum(0).astype(float), t.sum(0).astype(float), int(t.sum()), int(t0.sum()), len(c))
    root = totals.root(t.sum(1), t0)
    unknown = totals.root(np.zeros(1), np.zeros(1))[0]
    assert math.isclose(root.sum() + unknown, 1.0)
    own = (c - py.DISCOUNT * t) / (py.STRENGTH + totals.customers) + totals.backoff() * root[:, None]
    assert np.allclose(own.sum(0) + totals.backoff() * unknown, 1.0)


def test_blocks_of_any_size_give_the_same_base(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: r["base_score"] for r in py.scores(docs).collect()}
    rows = py._Block()
    for r in docs.limit(5).collect():
        rows.add(r["doc_id"], r["text"].encode())
    row = rows.row(1).to_pylist()[0]
    assert len(row["doc_ids"]) == 5 and len(row["entries"]) == len(rows.words)
    again = {r["doc_id"]: r["base_score"] for r in py.scores(docs.repartition(7)).collect()}
    assert all(abs(want[i] - again[i]) < 1e-9 for i in want)


def test_odd_rows(spark):
    rows = [(1, "a b a", "x"), (None, "a B", "y"), (2, None, "z"), (3, "", None), (1, "a b a", "x"), (4, "zz " * 30_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = py.scores(docs).collect()
    assert len(got) == len(rows) and all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["held_out"] and by[2]["n_tokens"] == 1 and by[4]["n_tokens"] == 30_001
    assert py.scores(docs.limit(0)).count() == 0
    only = py.scores(docs.where("doc_id is null")).collect()[0]
    assert only["train_tokens"] == 0 and only["n_known"] == 0 and math.isfinite(only["base_score"]) and math.isfinite(only["score"])


def test_each_preceding_word_has_a_restaurant(spark):
    # "fa" and "ta" end alike: only the whole word tells what follows
    learnt = [i for i in range(400) if not py.held_out(i)]
    rows = [(i, " ".join(["fa cold", "ta warm"][k % 2] for k in range(i, i + 6))) for i in learnt]
    probes = [i for i in range(400, 500) if py.held_out(i)][:2]
    rows += [(probes[0], "fa cold ta warm"), (probes[1], "fa warm ta cold")]
    got = {r["doc_id"]: r for r in py.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    right, wrong = (got[i] for i in probes)
    assert right["held_out"] and abs(right["base_score"] - wrong["base_score"]) < 1e-9
    assert right["score"] > wrong["score"] + 4


def test_scores_equal_brute_force_where_seating_is_fixed(spark):
    """Every pair occurs once, so restaurants and scores follow from the texts alone, but for the parent's tables."""
    learnt = [i for i in range(60) if not py.held_out(i)]
    texts = {i: f"a{i} b{i} c{i}" for i in learnt}
    probe = next(i for i in range(100, 200) if py.held_out(i))
    rows = [*texts.items(), (probe, f"a{learnt[0]} b{learnt[0]} zz")]
    py_scores = {r["doc_id"]: r["score"] for r in py.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    n, words = len(learnt), 3 * len(learnt) + 1
    # customers of the parent: one for each pair; its tables of "a", "b" and "c" words are one each, of the end token t of n
    fits = []
    for t in range(1, n + 1):
        totals = py.Totals(np.zeros(0), np.zeros(0), 4 * n, 3 * n + t, words)
        one, end, new = (float(totals.root(np.array([c]), np.array([k]))[0]) for c, k in ((1, 1), (n, t), (0, 0)))
        begin, single = (py.STRENGTH + py.DISCOUNT * n) / (py.STRENGTH + n), (py.STRENGTH + py.DISCOUNT) / (py.STRENGTH + 1)
        own = lambda m: (1 - py.DISCOUNT) / (py.STRENGTH + m)
        fits.append(math.log10(own(n) + begin * one) + math.log10(own(1) + single * one) + math.log10(single * new) + math.log10(end))
    assert min(fits) <= py_scores[probe] <= max(fits)


def test_pairs_in_several_buckets_are_counted_whole(spark, monkeypatch):
    rows = [(i, " ".join(f"x y{(i * 7 + k) % 50}" for k in range(40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(py, "BUCKET_TOKENS", 800)
    blocks = docs.mapInArrow(py._make_blocks, py.BLOCK_SCHEMA).localCheckpoint()
    words = py.vocabulary(blocks.selectExpr("inline(entries)")).localCheckpoint()
    _, pairs, state, totals = py.seating(blocks, words, 24_000)
    want = Counter()
    for i, x in rows:
        if not py.held_out(i):
            t = tokens(x)
            want.update(zip([b"", *t], t))
    names = {int(h): w for w in {w for p in want for w in p} for h in py.hashes_of([w])}
    found = pairs.collect()
    assert {(names[r["u"]], names[r["w"]]): r["c"] for r in found} == {p: c for p, c in want.items() if c > 1}
    assert len({r["bucket"] for r in found if names[r["u"]] == b"x"}) > 3
    held = {names[r["h"]]: r for r in state.collect()}
    assert all(held[u]["c"] == sum(c for p, c in want.items() if p[0] == u) for u in {p[0] for p in want})
    assert totals[-1].root_customers == sum(r["c0"] for r in held.values()) == sum(r["tables"] for r in held.values())


def test_seating_is_the_same_in_any_batches(spark):
    """Sweeps move a row for each bucket and shelf, not for each pair, and draw by bucket and shelf."""
    rows = [(i, " ".join(f"x{(i * k) % 7} y{(i * 7 + k) % 50}" for k in range(40))) for i in range(60)]
    docs, limit = spark.createDataFrame(rows, "doc_id long, text string"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, found = spark.conf.get(limit), []
    try:
        for parts, records in ((2, "10000"), (5, "7")):
            spark.conf.set(limit, records)
            found.append({r["doc_id"]: r["score"] for r in py.scores(docs.repartition(parts)).collect()})
    finally:
        spark.conf.set(limit, before)
    assert len(found[0]) == len(rows) and all(abs(s - found[1][i]) < 1e-6 for i, s in found[0].items())
