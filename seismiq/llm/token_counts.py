"""Token counts of a piece model, without ids.

A text falls into pre-tokens at places no piece of the vocabulary crosses: before
a run of blanks (the model writes a blank as U+2581, which begins words only) and
around a line end.  Merges cannot reach across, so the number of pieces of a text
is the sum over its pre-tokens.  Each block of documents (an Arrow batch) becomes
a table of per-document pre-token frequencies; the pieces of each distinct
pre-token are counted once by the library, joined to the frequencies by the
pre-token's number, and summed per document.  Counts are kept from block to block
in a table of bounded size.  Nothing is shuffled and no ids are made.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings in
a text are plain characters, as the library has it; repeated rows give equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, slices, text_or_empty

BLANK, MAX_KNOWN, BLOCK_ROWS = "▁", 400_000, 500


class PieceCounter:
    """Counts pieces of whole texts by their pre-tokens."""

    def __init__(self, model: bytes, max_known: int = MAX_KNOWN):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces) or self.model.encode("a", out_type=str)[0][0] != BLANK:
            raise ValueError("pieces of this model cross the pre-token boundaries")
        self.split = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n").findall
        self.line_end = len(self.model.encode("\n"))  # with the blank that the library puts first
        self.known: dict[str, int] = {}
        self.max_known = max_known

    def frequencies(self, text: str) -> Counter:
        return Counter(self.split(BLANK + text.replace(" ", BLANK))) if text else Counter()

    def _count(self, fresh: list[str]) -> list[int]:
        """Pieces of each pre-token; the library adds a blank, which is taken off again."""
        texts = [p[1:] if p[0] == BLANK else "\n" + p for p in fresh]
        off = [0 if p[0] == BLANK else self.line_end for p in fresh]
        got = self.model.encode(texts, num_threads=1) if texts else []
        # a pre-token that is the blank alone is the library's blank, which it leaves out for an empty text
        return [len(ids) - o if t else 1 for ids, o, t in zip(got, off, texts)]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text of a block."""
        tables = [self.frequencies(t) for t in texts]
        if len(self.known) > self.max_known:
            self.known.clear()
        known = self.known
        fresh = list({p for t in tables for p in t if p not in known})
        known.update(zip(fresh, self._count(fresh)))
        return np.array([sum(n * known[p] for p, n in t.items()) for t in tables], np.int64)


#: The counter that a Python worker keeps from task to task.
_WORKER: dict[bytes, PieceCounter] = {}


def _counter(model: bytes) -> PieceCounter:
    if model not in _WORKER:
        _WORKER.clear()
        _WORKER[model] = PieceCounter(model)
    return _WORKER[model]


def with_token_count(docs: DataFrame, model: bytes, text: str = "text", column: str = "n_tokens") -> DataFrame:
    """Add the number of pieces of each whole text (the model, half a megabyte, goes with the task)."""
    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(model)
        for texts in batches:
            # a block: as many documents as hold their frequencies at once
            parts = [counter.count(part.to_pylist()) for part in slices(texts, BLOCK_ROWS)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return bounded_batches(docs).withColumn(column, run(text_or_empty(text)))


def token_counts(docs: DataFrame, model: bytes, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    counted = with_token_count(docs.select("doc_id", "text"), model)
    return counted.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
