import hashlib
import random

from pyspark.sql import functions as F

from seismiq.llm import iblt


def brute(rows):
    """doc_id, n_chars, edited_sha256 by the order of (id, hash); distinct rows only."""
    out = []
    for k, (i, t) in enumerate(rows):
        n, cut = rows[(k + 1) % len(rows)][1], len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[:len(t) - cut] + n[:cut]).encode()).hexdigest()))
    return out


def pieces(text):
    out = []
    for line in text.split("\n"):
        w = line.split()
        out += [" ".join(w[i:i + 16]) for i in range(0, len(w), 16)]
    return out


def alike(a, b):
    from collections import Counter
    x, y = set(Counter(pieces(a)).items()), set(Counter(pieces(b)).items())
    return 1.0 if not x | y else len(x & y) / len(x | y)


def test_peeling_recovers_what_two_lists_do_not_share(spark):
    rng = random.Random(1)
    rows = []
    for k in range(120):
        common, a, b = (list({rng.getrandbits(62) for _ in range(rng.choice([0, 1, 4, 12, 30]))}) for _ in range(3))
        rows.append((k, common + a, b + common, len(set(a) ^ set(b))))
    frame = spark.createDataFrame(rows, "k long, a array<long>, b array<long>, n long")
    got = frame.select("n", iblt.differing(F.col("a"), F.col("b")).alias("d"),
                       iblt.peel(iblt.subtract(iblt.sketch(F.col("a"), 96), iblt.sketch(F.col("b"), 96)), 96).alias("found"), "a", "b").collect()
    assert all(r["d"] == r["n"] for r in got)
    peeled = [r for r in got if r["found"] is not None]
    assert len(peeled) > 100 and all(set(r["found"]) == set(r["a"]) ^ set(r["b"]) for r in peeled)


def test_a_sketch_too_small_gives_no_answer(spark):
    frame = spark.createDataFrame([(list(range(1, 60)), [])], "a array<long>, b array<long>")
    assert frame.select(iblt.peel(iblt.subtract(iblt.sketch(F.col("a"), 12), iblt.sketch(F.col("b"), 12)), 12)).first()[0] is None


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r for r in iblt.edited_fingerprints(docs).collect()}
    assert [(i, got[i]["n_chars"], got[i]["edited_sha256"]) for i, _ in rows] == brute(rows)
    for k, (i, t) in enumerate(rows):
        n, cut = rows[(k + 1) % len(rows)][1], len(t) // 4
        assert abs(got[i]["near_edited"] - alike(t, t[:len(t) - cut] + n[:cut])) < 1e-9
        assert abs(got[i]["near_next"] - alike(t, n)) < 1e-9
    prints = {}
    for i, t in rows:
        prints.setdefault(t, set()).add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set.union(*prints.values())) == len(prints)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(3, "three lines\nof a text\nhere", "x"), (1, None, "x"), (2, "", "y"), (None, "no id 😀é", "z"), (3, "three lines\nof a text\nhere", "x"),
                                  (3, "another text of three", "w")], "doc_id long, text string, fingerprint string")
    got = iblt.edited_fingerprints(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "3", "3", "3", "None"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[1]["near_next"] == 1.0 and by[1]["n_chars"] == 0
    assert by[None]["n_chars"] == 8 and by[None]["edited_sha256"] == hashlib.sha256("no id ".encode()).hexdigest()
    assert iblt.edited_fingerprints(docs.limit(0)).count() == 0
    alone = iblt.edited_fingerprints(docs.where("doc_id = 2")).collect()[0]
    assert alone["near_edited"] == alone["near_next"] == 1.0
