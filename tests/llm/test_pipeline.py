import hashlib
import random

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from seismiq.llm import bpe, decontam
from seismiq.llm.queries import VOCABULARY

SF = "/root/testdata/sf0.01"


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "byte_level_bpe"]
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_run_equals_its_stages_by_brute_force(spark):
    """What must be in the result and what must not, from the documents alone."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [" ".join(decontam.words_of(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert out.keys() <= docs.keys()
    assert not [i for i, q in labels.items() if q == 0 and i in out]
    assert not [i for i in out if any(x in " ".join(decontam.words_of(docs[i])) for x in items)]
    texts = [docs[i] for i in out]
    assert len(set(texts)) == len(texts)
    # of clean, labelled good documents without copies all stay
    from seismiq.llm.simhash import simhash
    prints = {i: simhash(t.encode()) for i, t in docs.items()}
    alone = [i for i, q in labels.items() if q == 1 and all(j == i or bin(prints[i] ^ p).count("1") > 4 for j, p in prints.items())]
    leaked = {i for i in alone if any(x in " ".join(decontam.words_of(docs[i])) for x in items)}
    assert alone and set(alone) - leaked <= out.keys()
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = random.Random(1).sample([i for i in out if "@" not in docs[i] and not any(c.isdigit() for c in docs[i])], 50)
    for i in plain:  # texts without personal data come through unchanged
        assert out[i]["n_tokens"] == len(library.encode_ordinary(docs[i]))
        assert out[i]["decoded_sha256"] == hashlib.sha256(docs[i].encode()).hexdigest()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where(F.lit(False)), SF).count() == 0


def test_stages_on_odd_rows(spark):
    """Null ids and texts, very long texts, repeated rows, and extra columns named like the operators' own."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    long = "long " * 60_000
    odd = [(None, None, None, None, None), (None, "no id at all", "en", "s", 3), (9_000_001, None, "en", None, 0), (9_000_002, "", None, "s", 0),
           (9_000_003, long, "en", "s", len(long)), (9_000_004, "the same row", "de", "s", 12), (9_000_004, "the same row", "de", "s", 12)]
    extra = {"ids": F.lit("i"), "decoded": F.lit("d"), "fingerprint": F.lit(7), "component_id": F.lit("c"), "score": F.lit(0.5), "spans": F.lit("s"),
             "contaminated": F.lit("x"), "label": F.lit(1), "n_tokens": F.lit("n")}
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns(extra)
    n = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert out.columns == docs.columns and len(rows) <= n
        assert all(r.ids == "i" and r.fingerprint == 7 and r.n_tokens == "n" for r in rows)
        assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(out) == n and sum(r.n_tokens == 0 for r in out) >= 3


def test_the_library_without_the_operators():
    """Only their absence is passed over."""
    import subprocess
    import sys

    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "corpus_pipeline" or name.startswith("seismiq.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert e.queries() and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in e.queries())
"""
    import os
    root = os.path.dirname(corpus_pipeline.__file__)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
    broken = code.replace('name.split(".")[0] == "corpus_pipeline" or name.startswith("seismiq.llm")', 'name == "xxhash_missing"').replace(
        "import __spark_entry__", "sys.modules['seismiq.llm.pii'] = None\nimport __spark_entry__")
    assert subprocess.run([sys.executable, "-c", broken], cwd=root, capture_output=True).returncode != 0
