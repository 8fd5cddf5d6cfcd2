"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The seeds of a test item are the pairs of its neighbouring words; a text hits
one where the two words stand side by side or with one word between them.  An
alignment that reaches the threshold holds at least ``least_seeds`` of the pairs
(shown there), so some of an item's most frequent pairs can go unused: half as
many as that are left out, those with most hits in the texts at hand, and a
passage must hold the remaining number of the rarer ones.  That is an exact
bound, whatever the frequencies: no copy is lost because its words are frequent
or because it stands in very many documents.  A passage that also shares enough
words with the item is aligned with it word by word (match 2, mismatch and gap
-1); it reaches as far to both sides as an alignment that counts can.  The score
is divided by that of a full match.

The benchmark is read in blocks of at most ``block_words`` words, each sent to
the executors, so the size of what is sent is bounded whatever the benchmark's;
every block is held against all documents.

Words are runs of letters and digits; in scripts without blanks between words
each character is one.

Defined results: null and empty texts match nothing; items of fewer than three
words match nothing; repeated documents get the same result
each; a document that matches several items reports the best score, then the
item that comes first; empty tables give no matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, materialise, slices, text_or_empty

LEAST_ITEM = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: A match reaches this share of the full score, and that of so many words at least.
THRESHOLD, LEAST_WORDS = 0.5, 8
BLOCK_WORDS = 1_000_000

#: Pairs of hits and items that are held at once.
HELD = 1_000_000

#: Thai to Myanmar, Khmer, kana, Han: blocks of characters that are words of their own.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
find_words = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+").findall


def words_of(text: str | None) -> list[str]:
    return find_words((text or "").lower())


def align(item: np.ndarray, passage: np.ndarray) -> int:
    """Smith-Waterman score of two arrays of word numbers."""
    steps = np.arange(1, len(passage) + 1) * -GAP
    row, best = np.zeros(len(passage) + 1, np.int64), 0
    for w in item:
        top = np.maximum(row[:-1] + np.where(passage == w, MATCH, MISMATCH), row[1:] + GAP)
        top = np.maximum(top, 0)
        # a gap in the item: the best cell to the left, less its distance
        row[1:] = np.maximum.accumulate(top + steps) - steps
        best = max(best, int(row.max()))
    return best


def least_seeds(n: int, share: float) -> int:
    """How many neighbouring pairs of an item of n words an alignment of at least this share holds.

    Let m words match.  Of the m - 1 steps from one match to the next, a skip
    words of the item (cost 1 at least), b skip two or more words of the text
    only (cost 2 at least) and c do neither: those are hits.  The score is at
    most 2m - a - 2b = 2c + 2 + a, and m + a <= n, so 2a <= n - 1 - c.  With a
    score of 2 * share * n this gives 3c >= (4 * share - 1) * n - 3.
    """
    return max(1, math.ceil(((4 * share - 1) * n - 3) / 3 - 1e-9))


class _Item:
    """A test item and its scores of passages; words are numbers."""

    def __init__(self, numbers: np.ndarray, threshold: float):
        self.numbers, self.n = numbers, len(numbers)
        self.own, self.counts = np.unique(numbers, return_counts=True)
        self.share = max(threshold, min(LEAST_WORDS, self.n) / self.n)
        seeds = least_seeds(self.n, self.share)
        self.unused = (seeds - 1) // 2
        self.needed = seeds - self.unused
        # an alignment that counts skips at most so many words
        self.slack = int(2 * self.n * (1 - self.share)) + 2

    def score(self, passage: np.ndarray) -> float | None:
        """Alignment score over that of a full match, if that is a match."""
        at = np.minimum(np.searchsorted(self.own, passage), len(self.own) - 1)
        common = np.bincount(at[self.own[at] == passage], minlength=len(self.own))
        if np.minimum(common, self.counts).sum() < self.share * self.n - 1e-9:
            return None
        s = align(self.numbers, passage) / (MATCH * self.n)
        return s if s >= self.share - 1e-9 else None


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, object, list[str]]]]:
    """(running number, item_id, words) in lists of a bounded number of words."""
    block, held = [], 0
    rows = benchmark.select("item_id", text_or_empty().alias("text")).orderBy("item_id", "text")
    for n, r in enumerate(rows.toLocalIterator()):
        w = words_of(r["text"])
        if len(w) < LEAST_ITEM:
            continue
        if block and held + len(w) > block_words:
            yield block
            block, held = [], 0
        block.append((n, r["item_id"], w))
        held += len(w)
    if block:
        yield block


class _Seeds:
    """The seeds of a block of test items: entries (pair, item, place in the item), sorted by pair."""

    def __init__(self, texts: list[list[str]], threshold: float):
        self.vocabulary: dict[str, int] = {}
        numbers = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64) for words in texts]
        self.items = [_Item(x, threshold) for x in numbers]
        self.base = len(self.vocabulary)
        pairs = np.concatenate([x[:-1] * self.base + x[1:] for x in numbers])
        self.pairs, entry = np.unique(pairs, return_inverse=True)
        order = np.argsort(entry, kind="stable")
        self.entry = entry[order]
        self.item = np.repeat(np.arange(len(texts)), [len(x) - 1 for x in numbers])[order]
        self.place = np.concatenate([np.arange(len(x) - 1) for x in numbers])[order]
        self.n, self.slack, self.unused, self.needed = (np.array([getattr(i, f) for i in self.items]) for f in ("n", "slack", "unused", "needed"))

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, pair) of every hit, by position."""
        found = []
        for step in (1, 2):
            first, second = words[:-step], words[step:]
            at = np.flatnonzero((first >= 0) & (second >= 0))
            code = first[at].astype(np.int64) * self.base + second[at]
            pair = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            hit = self.pairs[pair] == code
            found.append((at[hit], pair[hit]))
        at, pair = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at, kind="stable")
        return at[order], pair[order]

    def rare(self, pair: np.ndarray) -> np.ndarray:
        """The entries to look for: of each item all but those with most hits."""
        weight = np.bincount(pair, minlength=len(self.pairs))[self.entry]
        live = np.flatnonzero(weight)
        live = live[np.lexsort((-weight[live], self.item[live]))]
        item = self.item[live]
        rank = np.arange(len(live)) - np.searchsorted(item, item)
        return np.sort(live[rank >= self.unused[item]])

    def passages(self, at: np.ndarray, pair: np.ndarray, doc: np.ndarray, entries: np.ndarray) -> Iterator[tuple]:
        """(doc, item, start, end) of each passage that holds enough seeds of the item."""
        first, last = (np.searchsorted(self.entry[entries], pair, side) for side in ("left", "right"))
        many = last - first
        total = int(many.sum())
        if not total:
            return
        if total > HELD and doc[0] != doc[-1]:
            middle = int(np.searchsorted(np.cumsum(many), total // 2))
            cut = np.searchsorted(doc, doc[middle])
            cut = cut if cut else np.searchsorted(doc, doc[0], "right")
            for part in (slice(0, cut), slice(cut, None)):
                yield from self.passages(at[part], pair[part], doc[part], entries)
            return
        if total > HELD and (items := np.unique(self.item[entries])).size > 1:
            below = self.item[entries] < items[len(items) // 2]
            for part in (below, ~below):
                yield from self.passages(at, pair, doc, entries[part])
            return
        e = entries[np.repeat(first - np.cumsum(many) + many, many) + np.arange(total)]
        item, doc = self.item[e], np.repeat(doc, many)
        start = np.repeat(at, many) - self.place[e] - self.slack[item]
        order = np.lexsort((start, item, doc))
        item, doc, start = item[order], doc[order], start[order]
        end = start + self.n[item] + 2 * self.slack[item]
        # passages of an item are equally long: sorted by start they are sorted by end
        fresh = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] > end[:-1])]
        begin = np.flatnonzero(fresh)
        until = np.r_[begin[1:], total]
        enough = until - begin >= self.needed[item[begin]]
        begin, until = begin[enough], until[enough] - 1
        yield from zip(doc[begin].tolist(), item[begin].tolist(), start[begin].tolist(), end[until].tolist())


def _find(block, threshold: float):
    """The score of each text and item of the block that match."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _Seeds([words for _, _, words in block], threshold)
        number = seeds.vocabulary.get
        for batch in batches:
            # the words of all texts; two that no item has stand between two texts
            parts = [np.array([*[number(w, -1) for w in words_of(t)], -1, -1], np.int32)
                     for part in slices(batch.column(2)) for t in part.to_pylist()]
            ends = np.cumsum([len(x) for x in parts])
            words = np.concatenate(parts) if parts else np.empty(0, np.int32)
            at, pair = seeds.hits(words)
            doc = np.searchsorted(ends, at, "right")
            best: dict[tuple[int, int], float] = {}
            for d, k, start, end in seeds.passages(at, pair, doc, seeds.rare(pair)) if len(at) else ():
                low = int(ends[d]) - len(parts[d])
                s = seeds.items[k].score(words[max(low, start):min(int(ends[d]) - 2, end)])
                if s is not None:
                    best[d, k] = max(s, best.get((d, k), 0.0))
            rows = pa.array([d for d, _ in best], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([k for _, k in best], pa.int32()),
                                              pa.array(best.values(), pa.float64())], ["doc_id", "text_key", "item", "score"])
    return run


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text_key, item_id, item, score) for each document and item that match."""
    spark = docs.sparkSession
    keyed = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_key"),
                        text_or_empty().alias("text"))
    out = []
    for block in _blocks(benchmark, block_words):
        names = spark.createDataFrame([(k, i, n) for k, (n, i, _) in enumerate(block)], "item int, item_id long, item_no long")
        found = keyed.mapInArrow(_find(block, threshold), "doc_id long, text_key long, item int, score double")
        out.append(materialise(found.groupBy("doc_id", "text_key", "item").agg(F.max("score").alias("score"))
                               .join(F.broadcast(names), "item").select("doc_id", "text_key", "item_id", "item_no", "score"), "matches"))
    if not out:
        return spark.createDataFrame([], "doc_id long, text_key long, item_id long, item_no long, score double")
    return reduce(DataFrame.union, out)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, contaminated, item_id, score (best match; null, 0.0 if none), n_items."""
    best = (matches(docs, benchmark, **options).groupBy("doc_id", "text_key")
            .agg(F.max(F.struct("score", -F.col("item_no"), "item_id")).alias("best"), F.count("*").alias("n_items")))
    keyed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key")).alias("d")
    j = keyed.join(best.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.text_key") == F.col("b.text_key")), "left")
    return j.select(F.col("d.doc_id").alias("doc_id"), F.col("best").isNotNull().alias("contaminated"),
                    F.col("best.item_id").alias("item_id"), F.coalesce("best.score", F.lit(0.0)).alias("score"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that match no test item; all others go, whole."""
    bad = matches(docs, benchmark, **options).select("doc_id", "text_key").distinct().toDF("bad_id", "bad_key")
    # own names by position, so that no column of the table can clash
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.toDF(*own.values()).withColumn("key", F.xxhash64(text_or_empty(own["text"])))
    kept = keyed.join(bad, F.col(own["doc_id"]).eqNullSafe(F.col("bad_id")) & (F.col("key") == F.col("bad_key")), "left_anti")
    return kept.select(*[F.col(n).alias(c) for c, n in own.items()])
