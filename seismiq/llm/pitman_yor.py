"""Language-model scores by a hierarchical Pitman-Yor model.

Restaurants: one for each preceding token (one for the beginning of a text), all
with the same parent, the restaurant of no context, whose parent is the uniform
distribution over the vocabulary and one unknown word.  Customers of a context
restaurant are the tokens that follow it; each of its tables sends a customer to
the parent.

Seating is sampled by blocked Gibbs sweeps: all customers of a word in a
restaurant leave and are seated again one after the other, given the parent's
probability of the word and the restaurant's tables as they stood after the last
sweep.  Pairs of context and word are independent given those, so a sweep needs
the restaurants' tables and the words' customers and tables in the parent at the
pairs, and the sums of the new tables by restaurant and by word; only the parent's
totals pass through the driver.  A pair that occurs once has one table in any seating, so
sweeps take the pairs that occur twice or more, and the others enter as constants.
The first customers are seated one by one, later ones in blocks a quarter as long
as the queue before them (binomial draws), so a pair of any count takes a
logarithmic number of steps.  Predictive probabilities are averaged over the
sampled seatings.

Texts become blocks of documents (one task's, up to a number of characters) with
a dictionary each.  Dictionary entries, not tokens, are shuffled by word to sum the
counts; the vocabulary and its restaurants are kept on shelves, by hash.  A block's
pairs are shuffled as packed arrays to the bucket of their context, a frequent
context having several; there they are counted and seated, and from there what the
pairs own of their restaurants goes back to the block.  In a sweep a bucket sends
each shelf one row with the tables of all its names there, and the shelf answers
with one row.  Blocks ask the shelves for their dictionaries in the same way, and
score their documents with the answers.  Draws are seeded by bucket and shelf, so
scores do not depend on partitions and batches.  In restaurants a word is known by
64 bits of its hash, in the base score by itself.

Defined results: lower-casing is A-Z only; a null or empty text is the end token
alone; an id that is null is hashed as the empty text (held out); repeated rows
are each learnt from and scored; with no training tokens every token is unknown;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, discard, freed_shuffles, materialise, slices, text_or_empty

#: Pairs of context and word are spread over this many buckets at least, of about so many tokens; a context of more tokens
#: than a bucket's HEAVY-th part has several.
CONTEXTS, BUCKET_TOKENS, HEAVY = 16, 1_000_000, 8
#: Words are spread over as many shelves at least, of about so many tokens.
SHELF_TOKENS = 8_000_000
#: Discounts and strengths of the context restaurants and of their parent.
DISCOUNT, STRENGTH, ROOT_DISCOUNT, ROOT_STRENGTH = 0.8, 1.0, 0.5, 1.0
SAMPLES, SEED = 3, 7
BLOCK_CHARS = 24_000_000
#: Customers that are seated one by one; growth of the blocks after them.
SINGLE, GROWTH = 8, 1.25
END = b""

BLOCK_SCHEMA = "block long, doc_ids array<long>, n_tokens array<int>, ids binary, entries array<struct<word:binary,seen:int>>"


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def hashes_of(words: list[bytes]) -> np.ndarray:
    """What each word is known by in restaurants; the restaurant of the end token is that of beginnings."""
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64)


def _packed(values: np.ndarray, kind=np.int32) -> bytes:
    return pa.compress(values.astype(kind).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind=np.int32) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, np.dtype(kind).itemsize * n, codec="zstd", asbytes=True), kind)


def _pairs(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a block's tokens (context, word) and each token's pair; a text begins after the end token of another."""
    keys = np.zeros(len(ids), np.int64)
    keys[1:] = ids[:-1]
    keys *= size
    keys += ids
    order = np.argsort(keys)
    keys = keys[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    pair = np.empty(len(ids), np.int32)
    pair[order] = np.cumsum(first, dtype=np.int32) - 1
    keys = keys[first]
    return keys // size, keys % size, pair


def _learnt(doc_ids: list, n_tokens: np.ndarray) -> np.ndarray:
    """Whether each token of a block is learnt from."""
    return np.repeat(~np.array([held_out(d) for d in doc_ids]), n_tokens)


class _Block:
    """Documents with a dictionary of their words."""

    def __init__(self):
        self.words: dict[bytes, int] = {END: 0}
        self.ids, self.doc_ids, self.chars = [], [], 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        words, number = self.words, self.words.setdefault
        self.ids.append(np.array([*[number(w, len(words)) for w in text.lower().split()], 0], np.int32))
        self.doc_ids.append(doc_id)
        self.chars += len(text)

    def row(self, block: int) -> pa.RecordBatch:
        words, n = list(self.words), np.array([len(x) for x in self.ids], np.int64)
        ids = np.concatenate(self.ids)
        seen = np.bincount(ids[_learnt(self.doc_ids, n)], minlength=len(words))
        entries = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(seen, pa.int32())], ["word", "seen"])

        def one(values, kind):
            values = values if isinstance(values, pa.Array) else pa.array(values, kind)
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        return pa.RecordBatch.from_arrays(
            [pa.array([block]), one(self.doc_ids, pa.int64()), one(n, pa.int32()), pa.array([_packed(ids)], pa.binary()), one(entries, None)],
            ["block", "doc_ids", "n_tokens", "ids", "entries"])


def _make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rng, held = np.random.default_rng(), _Block()  # a block's number only has to differ from others'
    for batch in (x for b in batches for x in slices(b)):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.add(doc_id, text.encode("utf-8"))
            if held.chars >= BLOCK_CHARS:
                yield held.row(int(rng.integers(1 << 62)))
                held = _Block()
    if held.ids:
        yield held.row(int(rng.integers(1 << 62)))


def seat(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating each entry's customers: a new table with strength / (strength + n - discount * tables)."""
    tables, n = (customers > 0).astype(np.float64), 1
    live = np.flatnonzero(customers > 1)
    while len(live):
        m = n + 1 if n < SINGLE else int(n * GROWTH)
        a, new = strength[live], np.minimum(customers[live], m) - n
        p = a / (a + n + (new - 1) / 2 - discount * tables[live])
        tables[live] += rng.binomial(new, np.clip(p, 0.0, 1.0))
        n, live = m, live[customers[live] > m]
    return tables.astype(np.int64)


@dataclass
class Totals:
    """What restaurants hold: customers and tables of contexts, the parent's customers and tables, vocabulary size."""

    customers: np.ndarray
    tables: np.ndarray
    root_customers: int
    root_tables: int
    size: int

    def root(self, c0: np.ndarray, t0: np.ndarray) -> np.ndarray:
        """The parent's probability of words with these customers and tables."""
        return (c0 - ROOT_DISCOUNT * t0 + (ROOT_STRENGTH + ROOT_DISCOUNT * self.root_tables) / (self.size + 1)) / (ROOT_STRENGTH + self.root_customers)

    def backoff(self) -> np.ndarray:
        """What a context leaves to its parent."""
        return (STRENGTH + DISCOUNT * self.tables) / (STRENGTH + self.customers)


# ---- pairs of context and word ---------------------------------------------------

SPREAD = "bucket int, block long, n int, u binary, w binary, counts binary, places binary"
#: A bucket's own row has neither shelf nor block; rows with a shelf are its messages, rows with a block the block's pairs.
PARTS = "bucket int, shelf int, block long, n int, places binary, data binary"


def _all_packed(*arrays: np.ndarray) -> bytes:
    """Arrays of any types and lengths as one value."""
    data = b"".join([np.array([len(x) for x in arrays], np.int64).tobytes(), *(x.tobytes() for x in arrays)])
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _all_unpacked(value: pa.BinaryScalar, *kinds) -> list[np.ndarray]:
    packed = value.as_buffer()
    data = pa.decompress(packed[8:], int.from_bytes(packed[:8].to_pybytes(), "little"), codec="zstd", asbytes=True)
    out, at = [], 8 * len(kinds)
    for n, kind in zip(np.frombuffer(data, np.int64, len(kinds)).tolist(), kinds):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


def _spread(buckets: int, heavy: dict[int, int]):
    """A block's pairs as packed arrays, a row for each bucket; a heavy context has several buckets, by word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (x for b in batches for i in range(b.num_rows) for x in b.slice(i, 1).to_pylist()):
            n_tokens, words = np.array(row["n_tokens"], np.int64), row["words"]
            u, w, pair = _pairs(_unpacked(row["ids"], int(n_tokens.sum())), len(words))
            counts = np.bincount(pair[_learnt(row["doc_ids"], n_tokens)], minlength=len(u))
            hashes = hashes_of(words)
            several = np.fromiter((heavy.get(h, 1) for h in hashes.tolist()), np.uint64, len(hashes))
            hu, hw = hashes[u], hashes[w]
            bucket = (_mixed(hu.view(np.uint64)) + _mixed(hw.view(np.uint64)) % several[u]) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            parts = [(k, order[i:j]) for k, (i, j) in enumerate(zip(ends, ends[1:])) if i < j]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in parts], pa.int32()), pa.array([row["block"]] * len(parts), pa.int64()), pa.array([len(o) for _, o in parts], pa.int32()),
                 pa.array([_packed(hu[o], np.int64) for _, o in parts], pa.binary()), pa.array([_packed(hw[o], np.int64) for _, o in parts], pa.binary()),
                 pa.array([_packed(counts[o]) for _, o in parts], pa.binary()), pa.array([_packed(np.diff(o, prepend=0)) for _, o in parts], pa.binary())],
                ["bucket", "block", "n", "u", "w", "counts", "places"])
    return run


@dataclass
class Bucket:
    """A bucket's distinct pairs.

    ``counts`` of all pairs in order.  Names are the contexts and words that are learnt from, by shelf and hash:
    ``ends`` of the shelves among them, their ``places`` on the shelf (differences; from the first answer on), the
    numbers of their pairs that occur once (``singles`` as context, ``alone`` as word).  Pairs that occur more than
    once have the places of context ``u`` (differences) and word ``w`` among the names, the tables ``t`` of the last
    sweep and the sum of their tables over the sampled ones.
    """

    counts: np.ndarray
    ends: np.ndarray
    places: np.ndarray
    singles: np.ndarray
    alone: np.ndarray
    u: np.ndarray
    w: np.ndarray
    t: np.ndarray
    sampled: np.ndarray

    def packed(self) -> bytes:
        return _all_packed(*(getattr(self, f).astype(np.int32) for f in self.__dataclass_fields__))

    @classmethod
    def of(cls, value: pa.BinaryScalar) -> Bucket:
        return cls(*_all_unpacked(value, *[np.int32] * len(cls.__dataclass_fields__)))

    def rows(self, bucket: int, names: np.ndarray, blocks: list[tuple] = ()) -> pa.Table:
        """The bucket, what it has for each shelf (names, their tables as contexts and as words), and the rows of blocks."""
        a = self.singles + np.bincount(np.cumsum(self.u), self.t, len(names)).astype(np.int64)
        b = self.alone + np.bincount(self.w, self.t, len(names)).astype(np.int64)
        sent = [(k, None, None, None, _all_packed(names[i:j], a[i:j], b[i:j])) for k, (i, j) in enumerate(zip([0, *self.ends], self.ends)) if i < j]
        columns = list(zip((None, None, None, None, self.packed()), *sent, *((None, *x) for x in blocks)))
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.repeat(pa.scalar(bucket, pa.int32()), len(columns[0])), *(pa.array(x, k) for x, k in zip(columns, kinds))],
                        ["bucket", "shelf", "block", "n", "places", "data"])


def _count(shelves: int):
    """A bucket's distinct pairs, counted, with one table for each; for each block the places of its pairs among them."""
    def run(rows: pa.Table) -> pa.Table:
        def all_of(name: str, kind) -> np.ndarray:
            return np.concatenate([_unpacked(x.as_buffer(), n.as_py(), kind) for x, n in zip(rows.column(name), rows.column("n"))])

        names, found = np.unique(np.concatenate([all_of("u", np.int64), all_of("w", np.int64)]), return_inverse=True)
        by_shelf = np.lexsort((names, names % shelves))
        at = np.empty(len(names), np.int64)
        at[by_shelf], names = np.arange(len(names)), names[by_shelf]
        u, w = np.split(at[found], 2)
        keys = u * len(names) + w
        order = np.argsort(keys)
        keys = keys[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        pair = np.empty(len(keys), np.int32)
        pair[order] = np.cumsum(first) - 1
        c = np.add.reduceat(all_of("counts", np.int32)[order], np.flatnonzero(first), dtype=np.int64)
        u, w = (x(keys[first][c > 0], len(names)) for x in (np.floor_divide, np.mod))
        learnt = np.zeros(len(names), bool)
        learnt[u] = learnt[w] = True
        at, names = np.cumsum(learnt) - 1, names[learnt]
        u, w, single = at[u], at[w], c[c > 0] == 1
        ends = np.searchsorted(names % shelves, np.arange(shelves), side="right")
        singles, alone = (np.bincount(x[single], minlength=len(names)) for x in (u, w))
        one = np.ones(int((~single).sum()), np.int64)
        out = Bucket(c, ends, names[:0], singles, alone, np.diff(u[~single], prepend=0), w[~single], one, 0 * one)
        packed = [_packed(x) for x in np.split(pair, np.cumsum(rows.column("n").to_numpy())[:-1])]
        return out.rows(rows.column("bucket")[0].as_py(), names, list(zip(*(rows.column(x).to_pylist() for x in ("block", "n", "places")), packed)))
    return run


def _own(rows: pa.Table, seated: pa.Table) -> pa.Table:
    """What each block's pairs own of their restaurants: customers less discounted tables, the mean over the samples."""
    held = Bucket.of(seated.column("data")[0])
    own = held.counts - DISCOUNT * (held.counts > 0)
    more = held.counts > 1
    own[more] = held.counts[more] - DISCOUNT * held.sampled / SAMPLES
    parts = [own[_unpacked(x.as_buffer(), n.as_py())] for x, n in zip(rows.column("data"), rows.column("n"))]
    return pa.table([rows.column("block"), rows.column("n"), rows.column("places"), pa.array([_packed(x, np.float32) for x in parts], pa.binary())],
                    ["block", "n", "places", "own"])


# ---- seating -----------------------------------------------------------------------


def _seat_pairs(totals: Totals, sweep: int):
    """One sweep over a bucket's pairs, given the shelves' answers: tables of restaurants, customers and tables of words in the parent."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        bucket, held = left.column("bucket")[0].as_py(), Bucket.of(left.column("data")[0])
        answers = [_all_unpacked(right.column("data")[i], np.int64, np.int64, np.int64, np.int32) for i in np.argsort(right.column("shelf").to_numpy()).tolist()]
        tables, c0, t0, places = (np.concatenate(x) for x in zip(*answers)) if answers else [held.places] * 4
        held.places = held.places if sweep else places
        strength = (STRENGTH + DISCOUNT * tables[np.cumsum(held.u)]) * totals.root(c0[held.w], t0[held.w])
        held.t = seat(held.counts[held.counts > 1], strength, DISCOUNT, np.random.default_rng([SEED, sweep, 0, bucket]))
        held.sampled = held.sampled + held.t
        return held.rows(bucket, held.places.astype(np.int64))
    return run


#: A shelf's words with their hashes and counts; a shelf's restaurants, and as rows with a bucket its answers.
SHELF = "shelf int, words array<binary>, data binary"
STATE = "shelf int, bucket int, n long, c0 long, t0 long, data binary"


def _shelve(rows: pa.Table) -> pa.Table:
    words, data = rows.column("word").combine_chunks(), _all_packed(*(rows.column(x).to_numpy().astype(np.int64) for x in "hn"))
    return pa.table([rows.column("shelf")[:1], pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), pa.array([data], pa.binary())],
                    ["shelf", "words", "data"])


@dataclass
class Restaurants:
    """The restaurants of a shelf by hash: customers, tables, customers and tables of the word in the parent, and what was sampled of these."""

    h: np.ndarray
    c: np.ndarray
    tables: np.ndarray
    c0: np.ndarray
    t0: np.ndarray
    past: np.ndarray

    def packed(self) -> bytes:
        return _all_packed(*(getattr(self, f) for f in self.__dataclass_fields__))

    @classmethod
    def of(cls, value: pa.BinaryScalar) -> Restaurants:
        return cls(*_all_unpacked(value, *[np.int64] * 6))


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shelves' restaurants before any seating."""
    for b in batches:
        for shelf, value in zip(b.column("shelf").to_pylist(), b.column("data")):
            hashes, n = _all_unpacked(value, np.int64, np.int64)
            h, place = np.unique(hashes, return_inverse=True)
            c = np.bincount(place, n, len(h)).astype(np.int64)
            out = Restaurants(h, c, 0 * c, 0 * c, 0 * c + 1, c[:0])
            yield pa.RecordBatch.from_arrays([pa.array([shelf], pa.int32()), pa.array([out.packed()], pa.binary())], ["shelf", "data"])


def _move(totals: Totals | None, sweep: int):
    """A shelf's restaurants with the tables that the buckets' pairs have now, and the answers to the buckets.

    Buckets first name their restaurants by hash, and by what the answer says is their place from then on.  With ``totals``
    the parent's customers are seated again, and what restaurants and parent hold is added to ``past``.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        shelf, held = left.column("shelf")[0].as_py(), Restaurants.of(left.column("data")[0])
        sent = [_all_unpacked(x, *[np.int64] * 3) for x in right.column("data")]
        places = [np.cumsum(x) if totals else np.searchsorted(held.h, x) for x, _, _ in sent]
        held.tables, held.c0 = np.zeros(len(held.h), np.int64), np.zeros(len(held.h), np.int64)
        for place, (_, of_context, of_word) in zip(places, sent):  # a message has each name once
            held.tables[place] += of_context
            held.c0[place] += of_word
        if totals:
            up = (ROOT_STRENGTH + ROOT_DISCOUNT * totals.root_tables) / (totals.size + 1)
            held.t0 = seat(held.c0, np.full(len(held.c0), up), ROOT_DISCOUNT, np.random.default_rng([SEED, sweep, 1, shelf]))
            held.past = np.concatenate([held.past, held.tables, held.c0, held.t0])
        data = [held.packed(), *(_all_packed(held.tables[x], held.c0[x], held.t0[x], np.diff(x[:0] if totals else x, prepend=0).astype(np.int32)) for x in places)]
        none = [None] * len(sent)
        return pa.table([pa.repeat(pa.scalar(shelf, pa.int32()), len(data)), pa.array([None, *right.column("bucket").to_pylist()], pa.int32()),
                         *(pa.array([int(x), *none], pa.int64()) for x in (len(held.h), held.c0.sum(), held.t0.sum())), pa.array(data, pa.binary())],
                        ["shelf", "bucket", "n", "c0", "t0", "data"])
    return run


def _totals(state: DataFrame) -> Totals:
    r = state.agg(F.sum("c0").alias("c0"), F.sum("t0").alias("t0"), F.sum("n").alias("n")).first()
    return Totals(np.zeros(0), np.zeros(0), r["c0"] or 0, r["t0"] or 0, r["n"] or 0)


def vocabulary(entries: DataFrame) -> DataFrame:
    """word, its hash h and its count n in the training tokens."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array(hashes_of(b.column("word").to_pylist()), pa.int64()), b.column("n")], ["word", "h", "n"])

    words = entries.where("seen > 0").groupBy("word").agg(F.sum("seen").alias("n"))
    return words.mapInArrow(hashed, "word binary, h long, n long")


def shelves_of(tokens: int) -> int:
    return max(CONTEXTS, -(-tokens // SHELF_TOKENS))


def shelve(words: DataFrame, tokens: int) -> DataFrame:
    """The vocabulary, a row for each shelf."""
    by_shelf = words.select(F.pmod("h", F.lit(shelves_of(tokens))).cast("int").alias("shelf"), "word", "h", "n")
    return materialise(by_shelf.groupBy("shelf").applyInArrow(_shelve, SHELF), "shelves")


def heavy_contexts(words: DataFrame, tokens: int) -> dict[int, int]:
    """The buckets of contexts that have several, at most HEAVY contexts a bucket."""
    buckets, part = max(CONTEXTS, -(-tokens // BUCKET_TOKENS)), BUCKET_TOKENS // HEAVY
    return {r["h"]: min(buckets, -(-r["n"] // part)) for r in words.where(F.col("n") > part).select("h", "n").collect()}


OWN_ROWS = "block is null and shelf is null"


def seated(blocks: DataFrame, heavy: dict[int, int], shelved: DataFrame, tokens: int) -> tuple[DataFrame, DataFrame, DataFrame, list[Totals]]:
    """The buckets' rows as counted and as seated, the shelves' restaurants, and the parent's totals after each sampled sweep."""
    spread = (blocks.select("block", "doc_ids", "n_tokens", "ids", F.col("entries.word").alias("words"))
              .mapInArrow(_spread(max(CONTEXTS, -(-tokens // BUCKET_TOKENS)), heavy), SPREAD))
    counted = materialise(spread.groupBy("bucket").applyInArrow(_count(shelves_of(tokens)), PARTS), "pairs")

    def moved(restaurants: DataFrame, parts: DataFrame, totals: Totals | None, sweep: int) -> DataFrame:
        sent = parts.where("shelf is not null").select("shelf", "bucket", "data")
        return materialise(restaurants.groupBy("shelf").cogroup(sent.groupBy("shelf")).applyInArrow(_move(totals, sweep), STATE), "seating")

    parts, state = counted, moved(shelved.select("shelf", "data").mapInArrow(_open, "shelf int, data binary"), counted, None, 0)
    # the seating to begin with, one table for each pair, is not sampled
    totals = [_totals(state)]
    for sweep in range(SAMPLES):
        answers = state.where("bucket is not null").select("bucket", "shelf", "data")
        before = [state, *([parts] if sweep else [])]
        parts = materialise(parts.where(OWN_ROWS).select("bucket", "data").groupBy("bucket").cogroup(answers.groupBy("bucket"))
                            .applyInArrow(_seat_pairs(totals[-1], sweep), PARTS), "seated")
        state = moved(state.where("bucket is null").select("shelf", "data"), parts, totals[-1], sweep)
        for table in before:
            discard(table)
        totals.append(_totals(state))
    return counted, parts.where(OWN_ROWS), state.where("bucket is null"), totals[1:]


def seating(blocks: DataFrame, words: DataFrame, tokens: int) -> tuple[DataFrame, DataFrame, DataFrame, list[Totals]]:
    """The blocks' pairs by bucket, a row for each pair seated and for each restaurant, and the parent's totals."""
    def pairs_of(left: pa.Table, right: pa.Table) -> pa.Table:
        x = Bucket.of(left.column("data")[0])
        sent = [_all_unpacked(right.column("data")[i], *[np.int64] * 3)[0] for i in np.argsort(right.column("shelf").to_numpy()).tolist()]
        names = np.concatenate([*sent, np.zeros(0, np.int64)])
        columns = [names[np.cumsum(x.u)], names[x.w], x.counts[x.counts > 1], x.t, x.sampled]
        return pa.table([pa.repeat(left.column("bucket")[0], len(x.u)), *map(pa.array, columns)], ["bucket", "u", "w", "c", "t", "sampled"])

    def restaurants_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for value in (v for b in batches for v in b.column("data")):
            x = Restaurants.of(value)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (x.h, x.c, x.tables, x.c0, x.t0)], ["h", "c", "tables", "c0", "t0"])

    counted, parts, state, totals = seated(blocks, heavy_contexts(words, tokens), shelve(words, tokens), tokens)
    pairs = parts.groupBy("bucket").cogroup(counted.where("shelf is not null").groupBy("bucket"))
    return (counted.where("block is not null"), pairs.applyInArrow(pairs_of, "bucket int, u long, w long, c int, t int, sampled int"),
            state.mapInArrow(restaurants_of, "h long, c long, tables long, c0 long, t0 long"), totals)


# ---- scores ------------------------------------------------------------------------

#: What a block's entry gets: its count, its restaurant's customers, and of each sample tables, customers and tables in the parent.
ENTRY = 2 + 3 * SAMPLES
ASKED = "shelf int, block long, n int, places binary, words array<binary>"
VALUES = "block long, n int, places binary, data binary"


def _ask(shelves: int):
    """A block's dictionary, a row for each shelf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words = b.column("words").slice(i, 1).flatten()
                shelf = hashes_of(words.to_pylist()) % shelves
                order = np.argsort(shelf, kind="stable")
                ends = np.searchsorted(shelf[order], np.arange(shelves + 1))
                parts = [(k, order[i:j]) for k, (i, j) in enumerate(zip(ends, ends[1:])) if i < j]
                lists = pa.ListArray.from_arrays(pa.array(ends[[*(k for k, _ in parts), shelves]], pa.int32()), words.take(pa.array(order)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in parts], pa.int32()), pa.repeat(b.column("block")[i], len(parts)), pa.array([len(o) for _, o in parts], pa.int32()),
                     pa.array([_packed(np.diff(o, prepend=0)) for _, o in parts], pa.binary()), lists], ["shelf", "block", "n", "places", "words"])
    return run


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    """What the blocks' entries get from a shelf; nothing is known of words that it does not hold."""
    words, known = pa.array([], pa.binary()), np.zeros((ENTRY, 1), np.int64)
    if left.num_rows:
        shelf, state = (left.filter(f(left.column("words"))) for f in (pc.is_valid, pc.is_null))
        words, held = shelf.column("words").combine_chunks().flatten(), Restaurants.of(state.column("data")[0])
        hashes, n = _all_unpacked(shelf.column("data")[0], np.int64, np.int64)
        own = np.concatenate([held.c, held.past]).reshape(ENTRY - 1, -1)[:, np.searchsorted(held.h, hashes)]
        known = np.concatenate([np.concatenate([n[None], own]), known], axis=1)
    asked = right.column("words").combine_chunks()
    place = pc.fill_null(pc.index_in(asked.flatten(), words), len(words)).to_numpy()
    parts = np.split(place, np.cumsum(right.column("n").to_numpy())[:-1])
    return pa.table([right.column("block"), right.column("n"), right.column("places"), pa.array([_all_packed(known[:, x].ravel()) for x in parts], pa.binary())],
                    ["block", "n", "places", "data"])


OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(total: int, size: int, totals: list[Totals]):
    """A block's documents, given its entries' counts and restaurants and what its pairs own."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in ("doc_ids", "n_tokens", "ids")}
        n_tokens = np.array(row["n_tokens"], np.int64)
        ids = _unpacked(row["ids"], int(n_tokens.sum()))
        values, parts = (right.filter(f(right.column("data"))) for f in (pc.is_valid, pc.is_null))
        entries = np.zeros((ENTRY, int(pc.sum(values.column("n")).as_py())), np.int64)
        for n, places, data in zip(values.column("n").to_pylist(), values.column("places").to_pylist(), values.column("data")):
            entries[:, np.cumsum(_unpacked(places, n))] = _all_unpacked(data, np.int64)[0].reshape(ENTRY, n)
        known, c = entries[:2]
        u, w, pair = _pairs(ids, len(known))
        own = np.zeros(len(u))
        for n, places, values in zip(*(parts.column(x).to_pylist() for x in ("n", "places", "own"))):
            own[np.cumsum(_unpacked(places, n))] = _unpacked(values, n, np.float32)
        p = own / (STRENGTH + c)[u]
        for x, (tables, c0, t0) in zip(totals, entries[2:].reshape(SAMPLES, 3, -1)):
            backoff = Totals(c, tables, x.root_customers, x.root_tables, x.size).backoff()
            p += backoff[u] * x.root(c0, t0)[w] / SAMPLES
        base = np.log10((known + 0.1) / (total + 0.1 * (size + 1)))
        starts = np.cumsum(n_tokens) - n_tokens
        add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has the end token at least
        return pa.table([pa.array(row["doc_ids"], pa.int64()), pa.array([held_out(d) for d in row["doc_ids"]]), pa.array(n_tokens),
                         pa.array(add((known > 0)[ids].astype(np.int64))), pa.array(add(base[ids])), pa.array(add(np.log10(p)[pair]))],
                        ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    blocks = materialise(rows.mapInArrow(_make_blocks, BLOCK_SCHEMA), "blocks")
    with freed_shuffles(spark):
        words = materialise(vocabulary(blocks.selectExpr("inline(entries)")), "vocabulary")
        first = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("size")).first()
        heavy, shelved = heavy_contexts(words, first["total"]), shelve(words, first["total"])
        discard(words)
        counted, pairs, state, totals = seated(blocks, heavy, shelved, first["total"])
        places = counted.where("block is not null").select("bucket", "block", "n", "places", "data")
        own = materialise(places.groupBy("bucket").cogroup(pairs.select("bucket", "data").groupBy("bucket"))
                          .applyInArrow(_own, "block long, n int, places binary, own binary"), "own")
        for table in (counted, pairs):
            discard(table)
        asked = blocks.select("block", F.col("entries.word").alias("words")).mapInArrow(_ask(shelves_of(first["total"])), ASKED)
        shelf = shelved.unionByName(state.select("shelf", "data"), allowMissingColumns=True)
        values = materialise(shelf.groupBy("shelf").cogroup(asked.groupBy("shelf")).applyInArrow(_answer, VALUES), "values")
    both = values.unionByName(own, allowMissingColumns=True)
    scored = (blocks.drop("entries").groupBy("block").cogroup(both.groupBy("block"))
              .applyInArrow(_score(first["total"], first["size"], totals), OUT))
    return scored.withColumn("train_tokens", F.lit(first["total"]).cast("long"))
