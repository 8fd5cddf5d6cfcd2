import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from seismiq.llm import bpe
from seismiq.llm.queries import VOCABULARY, encoded

RANKS = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(encoder, text):
    data = encoder.encode(text)
    return [int.from_bytes(data[i:i + 4], "little") for i in range(0, len(data), 4)]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def test_random_texts_encode_as_the_library_does(encoder):
    rng = random.Random(3)
    for k in range(1500):
        if k % 3:
            text = "".join(rng.choice("abcdethnioeé漢😀12 \n\t<|>-_'s") for _ in range(rng.randint(0, 90)))
        else:
            text = "".join(chr(rng.randint(1, 0x3000)) for _ in range(30))
        assert ids(encoder, text) == LIBRARY.encode_ordinary(text)


def test_long_runs(encoder):
    for text in ("a" * 30_000, "ab" * 10_000 + "c", " " * 5_000, "é" * 4_000):
        assert ids(encoder, text) == LIBRARY.encode_ordinary(text)


def test_neighbouring_tokens_by_merges():
    t, rng = bpe.Transducer(RANKS), random.Random(5)
    for _ in range(4000):
        u, v = rng.randrange(4000), rng.randrange(len(RANKS))
        assert t._allowed(u, v) == (LIBRARY._encode_single_piece(t.tokens[u] + t.tokens[v]) == [u, v])


def test_tables_may_be_emptied_at_any_time():
    small = bpe.Transducer(RANKS, state_bytes=2000)
    for word in (b" internationalisation", b"antidisestablishmentarianism", "Übergrößenträger".encode()):
        assert small.encode(word) == LIBRARY._encode_single_piece(word)


def test_stream_decoder_waits_for_the_rest_of_a_character():
    tokens = {i: t for t, i in RANKS.items()}
    stream, text = bpe.StreamDecoder(tokens), "a漢😀é"
    parts = [RANKS[bytes([b])] for b in text.encode()]
    assert "".join([stream.feed([p]) for p in parts] + [stream.end()]) == text
    assert stream.feed(parts[:2]) == "a" and stream.end() == "�"


def test_documents(spark):
    rows = [(1, "Hello, wörld!", "x"), (2, None, "y"), (3, "", "z"), (1, "Hello, wörld!", "x"), (None, "漢字 <|endoftext|>", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, encoded(docs).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        own = LIBRARY.encode_ordinary(text or "")
        want.append((doc_id, len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    both = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, ids="n"), RANKS, ids="n")
    assert all((r["text"] or "") == r["decoded"] for r in both.collect())
    assert encoded(docs.limit(0)).count() == 0
