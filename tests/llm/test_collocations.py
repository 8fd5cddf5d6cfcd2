import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from seismiq.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, f long, phrase string, score long, rank long"


def brute(docs, top, least):
    counts = {}
    for text, lang in docs:
        c = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            for n in (1, 2, 3):
                c.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in counts.items():
        total, found = sum(f for p, f in c.items() if len(p) == 1), []
        frequent = {p: f for p, f in c.items() if len(p) > 1 and f >= least}
        covered = {q for p, f in frequent.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * f >= 50 * frequent[q]}
        for p, a in frequent.items():
            if p not in covered:
                score, _, left, right = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def mined(spark, docs, top, least):
    rows = spark.createDataFrame([(i, t, lang, 1, "p", 2, 3) for i, (t, lang) in enumerate(docs)], SCHEMA)
    out = co.collocations(rows, top, least)
    return sorted(tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def some_docs(seed=1, n=400):
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 5 == 0 else f"W{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    fixed = [" ".join(rng.choices(words, k=k)) for k in (2, 3, 4, 5, 8) for _ in range(4)]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.5 else " ".join(rng.choices(words, weights, k=rng.randint(1, 6))))
            parts.append(rng.choice([" ", "  ", "\t", ", ", ".", "\n", "!?", " : "]))
        docs.append(("".join(parts), rng.choice(["en", "en", "de", None])))
    return docs + [(None, "en"), ("", None), (" \t ", "fr"), ("one", "it"), ("a b c " * 20_000, "es"), *docs[:5], *docs[:5]]


@pytest.mark.parametrize(("top", "least"), [(2000, 10), (5, 10), (40, 3), (1, 2)])
def test_phrases_by_brute_force(spark, top, least):
    docs = some_docs()
    assert mined(spark, docs, top, least) == brute(docs, top, least)


def test_many_rounds_and_languages_that_settle_apart(spark, monkeypatch):
    """A first threshold that is too high is lowered for the languages that need it."""
    rounds, real = [], co.frontier
    monkeypatch.setattr(co, "frontier", lambda *a: rounds.append(1) or real(*a))
    monkeypatch.setattr(co, "FIRST_RANK", 0.1)
    docs = some_docs(2, 500) + [(f"x{i % 3} y{i % 3} z{i % 3}", "xx") for i in range(60)]
    assert mined(spark, docs, 30, 3) == brute(docs, 30, 3)
    assert len(rounds) > 1


def test_triples_outside_the_frontier_are_not_counted(spark, monkeypatch):
    """The bound prunes: fewer triples are counted than are frequent, and the result is the same."""
    docs, seen, real = some_docs(3, 600), [], co.scored_triples
    monkeypatch.setattr(co, "scored_triples", lambda t, *a: seen.append(t.count()) or real(t, *a))
    assert mined(spark, docs, 3, 3) == brute(docs, 3, 3)
    few = sum(seen)
    seen.clear()
    mined(spark, docs, 10 ** 6, 3)
    assert few < sum(seen)


def test_a_full_bit_set_changes_nothing(spark, monkeypatch):
    docs = some_docs(4, 200)
    monkeypatch.setattr(co, "bit_set", lambda grams, n: np.full(co.FILTER_BITS >> 6, 2 ** 64 - 1, np.uint64))
    assert mined(spark, docs, 10, 3) == brute(docs, 10, 3)


def test_the_bound_holds(spark):
    docs = some_docs(5, 300)
    rows = spark.createDataFrame(docs, "text string, lang string")
    words, pairs = co.ngrams(rows, 1).where("phrase != ''"), co.ngrams(rows, 2)
    triples = co.scored_triples(co.ngrams(rows, 3), pairs, words)
    bounds = co.scored_pairs(pairs, words).select("lang", "phrase", "bound", co.F.col("score").alias("own"))
    assert bounds.where("own > bound").isEmpty()
    assert triples.join(bounds.withColumnRenamed("phrase", "xy"), ["lang", "xy"]).where("score > bound").isEmpty()


def test_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(10 ** 13 + 7, 2 * 10 ** 13 + 1, 10 ** 13 + 9)], "a long, l long, r long")
    a, left, right = 10 ** 13 + 7, 2 * 10 ** 13 + 1, 10 ** 13 + 9
    assert big.select(co._score("a", "l", "r")).first()[0] == 10 ** 6 * a * a // (left * right)


def test_whole_table_against_sql(spark):
    """sf0.1: thousands of candidates, so that the frontier is cut."""
    path = "/root/testdata/sf0.1/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    expected = con.execute(co.ORACLE).fetchall()
    out = co.collocations(spark.read.parquet(path))
    assert sorted(tuple(r) for r in out.collect()) == sorted(expected) and len(expected) > 2000


def test_empty_table(spark):
    assert mined(spark, [], 10, 2) == []
    assert mined(spark, [(None, None), ("", "en")], 10, 2) == []
