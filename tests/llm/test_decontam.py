import random

import numpy as np

from seismiq.llm import decontam

WORDS = [f"w{i}" for i in range(4000)]


def brute_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def test_alignment_equals_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        a, b = [rng.randrange(5) for _ in range(rng.randint(1, 12))], [rng.randrange(5) for _ in range(rng.randint(1, 30))]
        assert decontam.align(np.array(a), np.array(b)) == brute_align(a, b)


def test_copies_edited_and_hot_are_found_and_clean_documents_left(spark):
    rng = random.Random(2)
    items = [passage(rng, n) for n in (16, 30, 55)]
    bench = spark.createDataFrame([(i, " ".join(w).capitalize() + ".") for i, w in enumerate(items)], "item_id long, text string")
    docs, want = [], {}

    def add(words, item):
        want[len(docs)] = item
        docs.append((len(docs), " ".join(words), "x"))

    for i, w in enumerate(items):
        add(passage(rng, 200) + [x.upper() + "," for x in w] + passage(rng, 100), i)
        edited = [rng.choice(WORDS) if k % 6 == 5 else x for k, x in enumerate(w)]
        add(passage(rng, 50) + edited + passage(rng, 5000), i)
        dropped = [x for k, x in enumerate(w) if k % 7 != 3]
        add(dropped + passage(rng, 20), i)
    for _ in range(60):  # one passage in a third of all documents
        add(passage(rng, 30) + items[1] + passage(rng, 30), 1)
    for _ in range(60):
        add(passage(rng, 300), None)
    add(passage(rng, 40) + items[2][:4] + passage(rng, 40), None)  # a few words in common are no copy
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    got = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in decontam.contaminated(frame, bench).collect()}
    assert got == {k: (v is not None, v) for k, v in want.items()}
    kept = decontam.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in want.items() if v is None}
    small = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in decontam.contaminated(frame, bench, block_words=20).collect()}
    assert small == got


def test_edited_and_partial_copies_in_a_third_of_all_documents(spark):
    rng = random.Random(5)
    items = [passage(rng, n) for n in (40, 24)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    edited = [f"other{k}" if k % 4 == 3 else x for k, x in enumerate(items[0])]  # a quarter of the grams stay
    partial = items[1][:13]  # a bit more than half: under half of the grams stay
    docs, want = [], {}
    for n, words in enumerate((edited, partial)):
        for _ in range(30):
            want[len(docs)] = n
            docs.append((len(docs), " ".join(passage(rng, 30) + words + passage(rng, 30))))
    for _ in range(60):  # a hot gram of an item alone is no copy
        want[len(docs)] = None
        docs.append((len(docs), " ".join(passage(rng, 60) + items[0][:3] + passage(rng, 60))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["item_id"] for r in decontam.contaminated(frame, bench).collect()} == want


def test_the_test_documents_against_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [" " + " ".join(decontam.words_of(r["text"])) + " " for r in bench.collect()]
    whole = {r["doc_id"] for r in docs.collect() if any(i in " " + " ".join(decontam.words_of(r["text"])) + " " for i in items)}
    found = {r["doc_id"] for r in decontam.contaminated(docs, bench).where("contaminated").collect()}
    assert whole and whole <= found
    assert len(found) <= len(whole) + 0.01 * docs.count()


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (2, None), (3, "too short"), (None, "alpha beta gamma delta epsilon zeta eta theta"),
                                   (1, "one two three four five six seven eight nine")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "One two, three four five six seven eight nine!"), (3, "One two, three four five six seven eight nine!"), (3, "other text"),
            (None, "alpha beta gamma delta epsilon zeta eta theta"), (4, "too short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["contaminated"], r["item_id"], r["score"]) for r in decontam.contaminated(docs, bench).collect())
    assert got == [("1", False, None, 0.0), ("2", False, None, 0.0), ("3", False, None, 0.0), ("3", True, 1, 1.0), ("3", True, 1, 1.0), ("4", False, None, 0.0),
                   ("None", True, None, 1.0)]
    assert decontam.drop_contaminated(docs, bench).count() == 4
    assert decontam.contaminated(docs.limit(0), bench).count() == 0
    assert decontam.contaminated(docs, bench.limit(0)).where("contaminated").count() == 0


def full_score(item, words):
    return brute_align(item, words) / (2 * len(item))


def test_every_alignment_that_reaches_the_threshold_is_found(spark):
    """Against Smith-Waterman over whole documents and all items: words changed, dropped, inserted; few and many words."""
    rng = random.Random(9)
    small = [f"s{i}" for i in range(40)]
    items = [passage(rng, n) for n in (9, 14, 20, 31)] + [[rng.choice(small) for _ in range(n)] for n in (10, 24)]
    docs = []
    for w in items:
        for every in (2, 3, 4, 5, 6):
            docs.append([f"o{k}" if k % every == every - 1 else x for k, x in enumerate(w)])
            docs.append([x for k, x in enumerate(w) if k % every])
            docs.append([y for k, x in enumerate(w) for y in ([x, f"i{k}"] if k % (every - 1) == 0 else [x])])
        docs.append([rng.choice([x, x, x, "e"]) for x in w if rng.random() < 0.9])
    docs = [passage(rng, 25) + w + passage(rng, 25) for w in docs] + [[rng.choice(small) for _ in range(120)] for _ in range(30)]
    want = {}
    for i, d in enumerate(docs):
        for k, w in enumerate(items):
            s = full_score(w, d)
            if s >= max(decontam.THRESHOLD, decontam.LEAST_WORDS / len(w)) - 1e-9:
                want[i, k] = s
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    frame = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontam.matches(frame, bench).collect()}
    assert got.keys() == want.keys() and len(want) > 50
    assert all(abs(got[x] - want[x]) < 1e-9 for x in got)


def test_passages_are_the_same_however_few_hits_are_held(monkeypatch):
    rng = random.Random(3)
    items = [["a", "b", *passage(rng, 8), "c"] for _ in range(12)]
    seeds = decontam._Seeds(items, 0.5)
    texts = [[seeds.vocabulary.get(x, -1) for w in rng.sample(items, 3) for x in w] + [-1, -1] for _ in range(9)]
    ends, words = np.cumsum([len(t) for t in texts]), np.array(sum(texts, []), np.int32)
    at, pair = seeds.hits(words)
    call = lambda: sorted(seeds.passages(at, pair, np.searchsorted(ends, at, "right"), seeds.rare(pair)))
    want = call()
    monkeypatch.setattr(decontam, "HELD", 5)
    assert call() == want and len(want) >= 27


def test_scripts_without_blanks(spark):
    item = "下列哪一项是光合作用的主要产物并且释放氧气"
    bench = spark.createDataFrame([(1, item), (2, "พืชสังเคราะห์แสงได้อย่างไรในเวลากลางคืน")], "item_id long, text string")
    rows = [(1, "前言。" + item + "？后记"), (2, "คำถาม พืชสังเคราะห์แสงได้อย่างไรในเวลากลางคืน?"), (3, "今天天气很好我们去公园散步"), (4, item[:9] + "某" + item[10:])]
    got = {r["doc_id"]: r["item_id"] for r in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {1: 1, 2: 2, 3: None, 4: 1}
    assert decontam.words_of("Ab 3下列é") == ["ab", "3", "下", "列", "é"]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a clean text", 1, 2, 3, 4), (2, "one two three four five six seven eight nine", 1, 2, 3, 4)],
                                 "doc_id long, text string, __id int, __key int, __text_key int, bad_id int")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "a clean text", 1, 2, 3, 4)]
