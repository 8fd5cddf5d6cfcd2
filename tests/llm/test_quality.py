import math
import re

from pyspark.sql import functions as F

from seismiq.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    part = F.pmod(F.xxhash64(F.lit("test"), "doc_id"), F.lit(2)) == 0
    model = quality.cotrain(docs, labels.where(~part))
    scored = model.score(docs).select("doc_id", "score", "text_score", "meta_score").join(labels.where(part), "doc_id").collect()
    good = [r["score"] >= 0.5 for r in scored if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["score"] < 0.5 for r in scored if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) >= 0.97 * len(junk)
    assert all(0 <= r[c] <= 1 for r in scored for c in ("score", "text_score", "meta_score"))


def test_toxic_documents_go(spark):
    """Held-out documents that are good but for a few words, wherever in a long text they stand."""
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    part = F.pmod(F.xxhash64(F.lit("test"), "doc_id"), F.lit(4)) == 0
    model = quality.cotrain(docs, labels.where(~part))
    scored = model.score(docs.join(labels.where(part), "doc_id")).select("doc_id", "quality", "toxic", "score").collect()
    toxic = [r["score"] < 0.5 for r in scored if r["toxic"] == 1]
    clean = [r["score"] >= 0.5 for r in scored if r["toxic"] == 0 and r["quality"] == 1]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) >= 0.99 * len(clean)


def test_telling_words_equal_brute_force(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fit = docs.join(labels.select("doc_id", (1.0 - F.col("toxic")).alias("__y")), "doc_id").select("text", "__y")
    seen, rows = {}, fit.collect()
    for r in rows:
        words = {w for w in re.findall(r"[^\W_]+", r["text"].lower()) if len(w) <= 40}
        for w in words | {w[:k] + "*" for w in words for k in (4, 5, 6, 7, 8) if len(w) > k}:
            n, bad = seen.get(w, (0, 0))
            seen[w] = n + 1, bad + (r["__y"] == 0)
    total, all_bad = len(rows), sum(r["__y"] == 0 for r in rows)

    def chi(n, bad):
        cells = ((bad, n, all_bad), (n - bad, n, total - all_bad), (all_bad - bad, total - n, all_bad), (total - all_bad - n + bad, total - n, total - all_bad))
        return sum((got - a * b / total) ** 2 / (a * b / total) for got, a, b in cells)

    want = {w: chi(*v) for w, v in seen.items() if 5 <= v[0] < total and chi(*v) >= 20}
    got = quality.telling_words(fit, 100_000)
    assert set(got) == set(want) and len(got) > 5
    ranked = [want[w] for w in got]
    assert all(a >= b - 1e-6 for a, b in zip(ranked, ranked[1:]))
    assert quality.telling_words(fit, 3) == got[:3]


def test_words_of_a_text():
    assert quality.text_words("") == set() and quality.text_terms(" \n ") == set()
    assert quality.text_words("It's ÜBER_all, über!\n" + "x" * 41) == {"it", "s", "über", "all"}
    assert quality.text_terms("abcdef") == {"abcdef", "abcd*", "abcde*"}


def test_features_of_a_text():
    assert quality.text_features(b"") == [0.0] * quality.N_FEATURES
    f = quality.text_features(b"AA aa 11 !!\n")
    assert len(f) == quality.N_FEATURES and math.isclose(f[0], 2 / 12) and math.isclose(f[1], 2 / 12) and math.isclose(f[5], 2 / 12)
    assert all(math.isfinite(x) for x in quality.text_features(b"x" * 100_000) + quality.text_features(b" \n\n "))


def test_each_view_teaches_the_other(spark):
    """Few labels: the text view, sure of the pool, lets the metadata view learn what sources mean."""
    good, bad = "plain words of a calm text that goes on", "### !!! $$$ %%% ### !!! $$$ @@@"
    rows = [(i, (bad if i % 2 else good) + f" {i}", "en", "spam" if i % 2 else "press", 40) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(16)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.score_all(docs, labels).collect()}
    assert all(out[i]["keep"] == (i % 2 == 0) for i in range(300))
    assert all((out[i]["meta_score"] > 0.5) == (i % 2 == 0) for i in range(300))


def test_odd_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("own")).withColumn("features", F.lit(1))
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, "", -5), (0, "x" * 50_000, "en", "src0", 50_000)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = base.unionByName(odd, allowMissingColumns=True)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels = labels.union(labels.limit(5)).union(spark.createDataFrame([(None, 1, 0), (5, None, None)], labels.schema))
    assert quality.score_all(docs, labels).where("score is null or keep is null").count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert kept.where("score <> 'own'").count() == 0
    assert quality.score_all(docs.limit(0), labels).count() == 0
    none = quality.score_all(docs, labels.limit(0))
    assert none.count() == docs.count() and none.where("not keep").count() == 0
    assert quality.keep_good(docs, labels.where("quality = 1 and toxic = 0")).count() == docs.count()
    assert quality.keep_good(docs.withColumn("__text_view", F.lit(1)), labels.drop("toxic")).columns == [*docs.columns, "__text_view"]


def test_every_unlabelled_document_teaches(spark):
    """Pseudo-labels come from the whole pool, and weigh no more than the labels."""
    rows = [(i, "calm words of a text" if i % 2 else "### !!! $$$ %%%", "en", "press" if i % 2 else "spam", 40) for i in range(400)]
    odd = [(1000 + i, "calm words of a text", "en", "late", 40) for i in range(30)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.score_all(docs, labels).collect()}
    assert all(out[1000 + i]["meta_score"] > 0.5 and out[1000 + i]["keep"] for i in range(30))
