"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit SimHashes over word shingles.  To find all pairs
within ``max_bits`` (4) differing bits, the 64 bits are dealt to three blocks
of 22, 21 and 21 bits; two linked fingerprints differ in at most one bit in
one of the blocks.  The binary Golay code of length 23 is a perfect covering
code of radius 3, so a block (padded with zeros) lies within 3 bits of exactly
one code word, its anchor, and a fingerprint whose block is one bit away lies
within 3 + 1 = 4 bits of that anchor.  Each fingerprint is therefore sent to
every anchor within 4 bits (5.3 on average for each block) and fingerprints
are compared inside an anchor's group only.

An anchor's group grows with the number of distinct fingerprints.  ``refine``
makes the groups finer without losing a pair: the other two blocks hold at
most ``max_bits`` differing bits, so of ``max_bits + refine`` parts of them at
least ``refine`` agree exactly; a group is then keyed by the anchor, one
choice of ``refine`` parts, and their value.  The result is the same for any
``refine``; by default it follows the number of distinct fingerprints.

Copies share a fingerprint and are merged before anything is compared, and a
group passes on a spanning forest of its links, never all pairs of a cluster.
Components come from alternating star contractions on the link table.

Defined results: a null or empty text (no words) has fingerprint zero and links
as any other; fewer words than a shingle hash as one shingle; repeated rows and
equal texts share a component; a component's id is its smallest non-null
doc_id (null if it has none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from seismiq.llm.common import bounded_batches, freed_shuffles, materialise, slices, text_or_empty

SEED = 42
#: Length, radius and generator polynomial of the binary Golay code.
LENGTH, RADIUS, POLYNOMIAL = 23, 3, 0b101011100011
#: Widths of the three blocks of a fingerprint.
BLOCKS = (22, 21, 21)
#: Mean rows of an anchor's group above which groups are made finer.
GROUP_ROWS = 2_000


def simhash(text: bytes, shingle: int = 4) -> int:
    """The fingerprint of one text (UTF-8), as an unsigned 64-bit integer."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only; space and 0x09-0x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    if n == 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = [0]
        for w in words:
            starts.append(starts[-1] + len(w) + 1)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[shingle:])]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for i in range(0, n, 1 << 16):  # long texts in slices
        part = values[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    values = (simhash(t) for part in slices(texts.cast(pa.binary())) for t in part.to_pylist())
    out = np.fromiter(values, np.uint64, len(texts))
    return pa.array(out.view(np.int64))


def with_fingerprint(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a signed 64-bit integer."""
    return bounded_batches(docs).withColumn(column, _fingerprints(text_or_empty(text)))


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


@lru_cache(maxsize=1)
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of single bits, and for each syndrome the errors of at most 4 bits (padded by the first)."""
    top = LENGTH - 12  # the polynomial has degree 11

    def syndrome(word: int) -> int:
        for i in range(top, -1, -1):
            if word >> (i + 11) & 1:
                word ^= POLYNOMIAL << i
        return word

    bits = [syndrome(1 << i) for i in range(LENGTH)]
    errors: list[list[int]] = [[] for _ in range(1 << 11)]
    for k in range(RADIUS + 2):
        for chosen in combinations(range(LENGTH), k):
            s = e = 0
            for i in chosen:
                s, e = s ^ bits[i], e | 1 << i
            errors[s].append(e)
    table = np.full((1 << 11, max(map(len, errors))), -1, np.int64)
    for s, es in enumerate(errors):
        table[s, :len(es)] = es
    # syndromes of the low 12 and of the high 11 bits, looked up separately
    low = np.zeros(1 << 12, np.int64)
    high = np.zeros(1 << 11, np.int64)
    for i, s in enumerate(bits):
        part, j = (low, i) if i < 12 else (high, i - 12)
        part[(np.arange(part.size) >> j & 1) == 1] ^= s
    return low, high, table


def _keys(fps: np.ndarray, max_bits: int, refine: int) -> tuple[np.ndarray, np.ndarray]:
    """(group key, row index) for every anchor within the covering radius plus one of a block."""
    low, high, table = _code()
    keys, rows, group = [], [], 0
    shift = 0
    for width in BLOCKS:
        block = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        rest = (fps & np.uint64((1 << shift) - 1)) | (fps >> np.uint64(shift + width) << np.uint64(shift))
        shift += width
        word = block.astype(np.int64)
        err = table[low[word & 0xFFF] ^ high[word >> 12]]
        r, c = np.nonzero(err >= 0)
        anchor = (word[r] ^ err[r, c]).astype(np.uint64)
        if not refine:
            keys.append(np.uint64(group) << np.uint64(56) | anchor)
            rows.append(r)
            group += 1
            continue
        cut = np.linspace(0, 64 - width, max_bits + refine + 1).astype(int)
        for chosen in combinations(range(max_bits + refine), refine):
            value = np.zeros(len(fps), np.uint64)
            for j in chosen:
                w = int(cut[j + 1] - cut[j])
                value = value << np.uint64(w) | (rest >> np.uint64(cut[j])) & np.uint64((1 << w) - 1)
            # 23 bits of anchor and up to 33 of value are folded to 56
            mixed = (anchor * np.uint64(0x9E3779B97F4A7C15) ^ value[r] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(8)
            keys.append(np.uint64(group) << np.uint64(56) | mixed)
            rows.append(r)
            group += 1
    return np.concatenate(keys), np.concatenate(rows)


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all fingerprints of a group which are connected within it."""
    m = len(fps)
    if m <= 1024:
        near = np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits, 1)
        a, b = np.nonzero(near)
        if len(a) <= 4 * m:
            return [(fps[a], fps[b])]
    out, rest = [], fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = np.bitwise_count(rest ^ x) <= max_bits
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                out.append((np.full(len(found), x), found))
                queue.extend(found)
    return out


def _replicate(max_bits: int, refine: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            keys, rows = _keys(fps, max_bits, refine)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fps[rows].view(np.int64))], ["key", "fp"])
    return run


def _compare(max_bits: int):
    """Links inside each group; rows come sorted by key, a group may span batches."""
    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
        size = ends - starts
        found = []
        pair = starts[size == 2]
        near = np.bitwise_count(fps[pair] ^ fps[pair + 1]) <= max_bits if len(pair) else np.zeros(0, bool)
        found.append((fps[pair[near]], fps[pair[near] + 1]))
        for s, e in zip(starts[size > 2], ends[size > 2]):
            found += _forest(fps[s:e], max_bits)
        a, b = (np.concatenate(x) for x in zip(*found))
        lo, hi = np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64))
        both = np.unique(np.stack([lo, hi], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.concatenate([keys, b.column(0).to_numpy()])
            fps = np.concatenate([fps, b.column(1).to_numpy().view(np.uint64)])
            done = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if done:
                yield links(keys[:done], fps[:done])
                keys, fps = keys[done:], fps[done:]
        if len(keys):
            yield links(keys, fps)
    return run


def links(distinct: DataFrame, count: int, max_bits: int = 4, refine: int | None = None) -> DataFrame:
    """(u, v) links between distinct fingerprints of the one column ``fp``."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the anchors cover up to 4 differing bits")
    if refine is None:
        refine, group = 0, 5.3 * count / (1 << 12)
        while group > GROUP_ROWS and refine < 3:
            refine += 1
            group = 5.3 * count / (1 << 12 + refine * (42 // (max_bits + refine)))
    spark = distinct.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (distinct.select("fp")
            .mapInArrow(_replicate(max_bits, refine), "key long, fp long")
            .repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(_compare(max_bits), "u long, v long").distinct())


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction: neighbours (small: the lower ones) are linked to the lowest."""
    if small:
        n = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        n = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = n.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    j = n.join(low, "u")
    if small:
        out = (j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(low.select("u", F.col("m").alias("v"))))
    else:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): every node that is not the lowest of its component, with the lowest.

    Rounds are logarithmic in the length of chains; each is written to the
    shared folder.
    """
    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialise(edges, "links")
    before = mark(edges)
    while True:
        edges = materialise(_star(_star(edges, small=False), small=True), "links")
        now = mark(edges)
        if now == before:
            return edges.select("u", F.col("v").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, max_bits: int = 4, refine: int | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id, and
    ``text_key`` (md5 of the text), which tells documents of one id apart."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.md5(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    marked = materialise(with_fingerprint(keyed).drop("text"), "fingerprints")
    with freed_shuffles(spark):
        distinct = materialise(marked.groupBy(F.col("fingerprint").alias("fp"))
                               .agg(F.min("doc_id").alias("first_id")), "distinct")
        roots = components(links(distinct, distinct.count(), max_bits, refine))
        of = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left") \
            .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
        lowest = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
        labels = materialise(of.join(lowest, "root").select(F.col("fp").alias("fingerprint"), "component_id", "root"), "labels")
    return marked.join(labels, "fingerprint")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one left of each group: the lowest doc_id, then text key.

    Documents without an id come after all others of their group; equal rows
    (same id, same text) leave one.
    """
    found = near_duplicates(docs)
    kept = (found.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k"))
            .select(F.col("k.doc_id").alias("__id"), F.col("k.text_key").alias("__key")))
    keyed = docs.withColumn("__text_key", F.md5(text_or_empty()))
    once = (keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["__id"]) & (keyed["__text_key"] == kept["__key"]), "left_semi")
            .dropDuplicates(["doc_id", "__text_key"]))
    return once.select(*docs.columns)
