import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from seismiq.llm import filter_audit

SCHEMA = "doc_id long, text string, lang string, n long, fails string, part string, digest string"
LABELS = "doc_id long, quality int, toxic int, n long"


def letters(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    found = "A" if len(words) < 200 else ""
    found += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    found += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    return found + ("D" if re.search("[#$%&*|]", text) else "")


def brute(docs, labels):
    lowest = {}
    for i, t, _ in docs:
        if i is not None:
            lowest[t or ""] = min(i, lowest.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    rows = [(lang or "", letters(t or "") + ("E" if i is not None and i > lowest[t or ""] else ""), i in good, i in toxic) for i, t, lang in docs]
    out, shapley = defaultdict(Counter), Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            alive = [r for r in rows if r[0] == part]
            everyone = list(alive)
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if f in r[1]]
                alive = [r for r in alive if f not in r[1]]
                out[part, order, step] = {
                    "kept": len(alive), "removed": len(gone), "redundant": sum(f in r[1] for r in everyone) - len(gone) - 0,
                    "unique_fails": sum(r[1] == f for r in everyone), "good_lost": sum(r[2] for r in gone), "toxic_lost": sum(r[3] for r in gone)}
                shapley[part, f] += len(gone)
    return {(p, o, s): (*v.values(), shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audited(spark, docs, labels):
    d = spark.createDataFrame([(*r, 5, "A", "p", "d") for r in docs], SCHEMA)
    found = filter_audit.audit(d, spark.createDataFrame([(*r, 9) for r in labels], LABELS))
    rows = [tuple(r) for r in found.select("part", "filter_order", "step", *filter_audit.MEASURES, "shapley").collect()]
    assert len(rows) == len({r[:3] for r in rows})
    return {r[:3]: r[3:] for r in rows}


def some_docs():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words[:rng.choice([60, 400])], k=rng.choice([150, 199, 200, 260]))) for _ in range(40)]
    texts += [t.upper() for t in texts[:8]] + [t + rng.choice(" #$%&*|") for t in texts[8:16]] + ["", " \t\n\x0b\x0c\r", "ÄÖÜ é " * 100, "A" * 3 + "é" * 97, "A" * 4 + "é" * 96]
    texts += [" ".join(f"v{i}" for i in range(100)) + " x" * 100, " ".join(f"v{i}" for i in range(99)) + " x" * 101]  # half distinct, and a word less
    docs = [(i, rng.choice([texts[0], rng.choice(texts)]), rng.choice(["en", "de", "", None])) for i in rng.sample(range(1000), 160)]
    docs += [(None, texts[0], "en"), (None, None, "en"), (None, texts[0], None), (5000, None, "xx"), (5001, "", "xx"), (5002, texts[1], "xx")]
    return docs + [docs[0], docs[0], (docs[0][0], docs[0][1], "fr"), (docs[1][0], "two texts of one id", "en"), (-1, "é" * 200_000 + " a" * 300, "en")]


def test_counts_by_brute_force(spark):
    docs = some_docs()
    labels = [(i, random.Random(i).choice([0, 1, None]), random.Random(-i).choice([0, 1, 1, None])) for i, _, _ in docs if i is not None and i % 2]
    labels = list(dict.fromkeys(labels)) + [(labels[0][0], 1, 0), (labels[0][0], 0, 1), (None, 1, 1), (10 ** 9, 1, 1)]
    found, expected = audited(spark, docs, labels), brute(docs, labels)
    assert found == expected
    assert all(any(k[0] == p for k in found) for p in ("", "en", "de", "fr", "xx")) and len(found) % 600 == 0


def test_each_letter_is_met(spark):
    cells = {c.fails for c in filter_audit.cells(spark.createDataFrame([(*r, 5, "A", "p", "d") for r in some_docs()], SCHEMA),
                                               spark.createDataFrame([], LABELS)).collect()}
    assert all(any(f in c for c in cells) for f in "ABCDE") and "" in cells


def test_copies_across_parts_and_a_repeated_lowest_id(spark):
    docs = [(1, "t", "en"), (1, "t", "de"), (1, "t", "en"), (2, "t", "en"), (3, "t", None)]
    found = audited(spark, docs, [])
    assert found["en", "EABCD", 1][:2] == (2, 1) and found["de", "EABCD", 1][:2] == (1, 0) and found["", "EABCD", 1][:2] == (0, 1)
    assert found == brute(docs, [])


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    assert audited(spark, [], [(1, 1, 1)]) == {}
