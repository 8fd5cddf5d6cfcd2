import random

import public_tokenizers
import sentencepiece

from seismiq.llm import token_counts
from seismiq.llm.queries import PIECES

MODEL = open(public_tokenizers.path(PIECES), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
TEXTS = ["", " ", "  ", "\n", "\n\n a", "▁", "a▁ b", "<s>x</s>", "ﬁ漢😀", " lead", "trail ", "a\tb\r\nc", "\x00", "x" * 20_000, "one two  three   four"]


def test_counts_equal_the_library():
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abcthe  \n\t▁<s>é漢😀1.-") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    want = [len(LIBRARY.encode(t)) for t in texts]
    assert token_counts.PieceCounter(MODEL).count(texts).tolist() == want
    small = token_counts.PieceCounter(MODEL, max_known=5)
    assert [n for i in range(0, len(texts), 100) for n in small.count(texts[i:i + 100])] == want


def test_documents(spark):
    rows = [*enumerate(TEXTS), (99, None), (None, "no id"), (0, "again")]
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_counts.token_counts(docs, MODEL, limit=100).collect()), key=str)
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or "")), len(LIBRARY.encode(t or "")) > 100) for i, t in rows]
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(docs.limit(0), MODEL).count() == 0
