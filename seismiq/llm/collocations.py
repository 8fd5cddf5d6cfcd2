"""Phrase collocations by best-first branch and bound over prefix counts.

A phrase is scored by its lowest-scoring cut, 1000000 * f(phrase)^2 /
(f(first part) * f(rest)).  Phrases grow from their prefixes: an extension of a
prefix is no more frequent than the prefix, and the rest after its first word is
at least as frequent as the whole, so that

    score(w1 w2 w3) <= 1000000 * f(w1 w2) / f(w1),

a bound that needs the counts of the prefix alone.  Words have the same bound,
so all frequent words are expanded first, which gives the pairs; then, in each
language, the prefixes whose bound reaches a threshold are expanded, best first,
in batches: the threshold is the score of a pair of some rank, which grows from
round to round.  Above a threshold every triple is known.  Whether a pair above
it survives is settled by expanding also the prefixes (x, w1) that are frequent
enough to be cut short by it.  A language is settled when ``top`` phrases at or
above its threshold survive, ties of the last of them included, or when its
whole frontier is expanded.  Languages that are settled are not expanded again.

A pass over the texts counts n-grams by blocks of text (numpy), and counts are
summed by phrase in Spark.  Passes after the first drop n-grams that are not to
be expanded by a bit set of fixed size (``FILTER_BITS``); its false positives are
counted like others and are complete, so they change nothing.  No table that
grows with the input is broadcast or gathered.

Defined results: a null text is the empty text, a null lang is ``und``; rows
that repeat count one by one; an empty table, or languages without frequent
phrases, give no rows; other columns are ignored.  A text is held as a whole by
the task that counts it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, materialise, slices, text_or_empty

TOP, LEAST, COVER_PERCENT, MILLION, NO_LANG = 2000, 10, 50, 1_000_000, "und"
BLOCK_BYTES, FILTER_BITS = 4 << 20, 1 << 25
#: Rank of the pair whose score is the first threshold, as a multiple of ``top``, and its growth a round.
FIRST_RANK, RANK_GROWTH = 2, 4
#: Factors of the language's and the words' checksums in the bit set's index.
LANG_FACTOR, WORD_FACTORS = 30_011, (40_503, 60_493)

# ---- fixed values: what ends a piece, what ends a word, letters in lower case ----
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# -----------------------------------------------------------------------------------


class Block:
    """The words of some texts: codes into a dictionary, language and piece of each."""

    def __init__(self, texts: list[bytes], langs: list[bytes]):
        names = sorted(set(langs))
        code = {x: i for i, x in enumerate(names)}
        joined = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
        kind = _KIND[joined]
        inside = np.concatenate(([False], kind == 0, [False]))
        starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined[kind == 0])])
        coded = words.dictionary_encode()
        self.names, self.dictionary, self.code = names, coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
        first = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        lang = np.array([code[x] for x in langs], np.int64)
        self.lang = lang[np.searchsorted(first, starts, side="right") - 1]

    def _checksums(self) -> tuple[np.ndarray, np.ndarray]:
        crc = zlib.crc32
        return (np.array([crc(x) for x in self.names], np.int64),
                np.fromiter((crc(x) for x in self.dictionary.to_pylist()), np.int64, len(self.dictionary)))

    def starts(self, n: int) -> np.ndarray:
        """Where n words of one piece begin."""
        m = len(self.code) - n + 1
        return np.flatnonzero(self.piece[:m] == self.piece[n - 1:]) if m > 0 else np.zeros(0, np.int64)

    def listed(self, at: np.ndarray, n: int, bits: np.ndarray) -> np.ndarray:
        """Whether the n words from each place are in the bit set."""
        if not hasattr(self, "crc"):
            self.crc = self._checksums()
        index = self.crc[0][self.lang[at]] * LANG_FACTOR
        for i in range(n):
            index = index + self.crc[1][self.code[at + i]] * WORD_FACTORS[i]
        index %= FILTER_BITS
        return (bits[index >> 6] >> (index & 63).astype(np.uint64)) & np.uint64(1) == 1

    def counted(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """One place of each distinct n-gram among those at the places, and how often it stands there."""
        key, size = self.lang[at], max(1, len(self.dictionary))
        for i in range(n):
            if len(key) and int(key.max()) >= (1 << 62) // size:
                key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            key = key * size + self.code[at + i]
        _, where, times = np.unique(key, return_index=True, return_counts=True)
        return at[where], times

    def rows(self, at: np.ndarray, n: int, times: np.ndarray) -> pa.RecordBatch:
        import pyarrow.compute as pc

        words = [self.dictionary.take(pa.array(self.code[at + i])) for i in range(n)]
        phrase = pc.binary_join_element_wise(*words, b" ") if n > 1 else words[0]
        lang = pa.array(self.names, pa.binary()).take(pa.array(self.lang[at]))
        return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(times, pa.int64())], ["lang", "phrase", "f"])

    def totals(self) -> pa.RecordBatch:
        """The number of words of each language, under the empty phrase."""
        n = np.bincount(self.lang, minlength=len(self.names))
        return pa.RecordBatch.from_arrays([pa.array(self.names, pa.binary()).cast(pa.string()), pa.array([""] * len(n)), pa.array(n, pa.int64())],
                                          ["lang", "phrase", "f"])


def ngrams(docs: DataFrame, n: int, *filters: tuple[int, int, np.ndarray]) -> DataFrame:
    """(lang, phrase, f): n-grams of the texts, summed; ``filters``: words from, number of words, bit set they are in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(texts: list[bytes], langs: list[bytes]) -> Iterator[pa.RecordBatch]:
            b = Block(texts, langs)
            at = b.starts(n)
            for skip, m, bits in filters:
                at = at[b.listed(at + skip, m, bits)]
            at, times = b.counted(at, n)
            for i in range(0, len(at), 65_536):
                yield b.rows(at[i:i + 65_536], n, times[i:i + 65_536])
            if n == 1:
                yield b.totals()

        texts, langs, size = [], [], 0
        for part in (x for batch in batches for x in slices(batch)):
            texts += part.column(0).to_pylist()
            langs += part.column(1).to_pylist()
            size += part.column(0).nbytes
            if size >= BLOCK_BYTES:
                yield from block(texts, langs)
                texts, langs, size = [], [], 0
        if texts:
            yield from block(texts, langs)

    rows = bounded_batches(docs).select(text_or_empty().cast("binary").alias("text"),
                                        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).cast("binary").alias("lang"))
    return rows.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _words(phrase: Column | str = "phrase") -> Column:
    return F.split(phrase, " ")


def bit_set(grams: DataFrame, n: int) -> np.ndarray:
    """The bit set of the n-grams' words: FILTER_BITS bits, however many rows there are."""
    index = F.crc32(F.col("lang").cast("binary")) * LANG_FACTOR
    for i in range(n):
        index = index + F.crc32(_words()[i].cast("binary")) * WORD_FACTORS[i]
    index = index % FILTER_BITS
    rows = grams.select(index.alias("i")).groupBy(F.shiftright("i", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(i & 63 as int))")).alias("b")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    bits[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return bits.view(np.uint64)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly: counts up to 10^14."""
    d = [f"cast({x} as decimal(14, 0))" for x in (a, left, right)]
    return F.expr(f"(cast({MILLION} as decimal(7, 0)) * ({d[0]} * {d[0]})) div ({d[1]} * {d[2]})")


def scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score, and bound: what no extension of the pair exceeds."""
    w = words.select("lang", F.col("phrase").alias("w"), F.col("f").alias("fw"))
    out = pairs.select("lang", "phrase", F.col("f").alias("a"), _words()[0].alias("w1"), _words()[1].alias("w2"))
    for name, count in (("w1", "l"), ("w2", "r")):
        out = out.join(w.withColumnsRenamed({"w": name, "fw": count}), ["lang", name])
    return out.select("lang", "phrase", "w1", "w2", "a", "l", "r", _score("a", "l", "r").alias("score"), F.expr(f"({MILLION} * a) div l").alias("bound"))


def scored_triples(triples: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score by the lowest-scoring cut, the shorter first part at ties; and both pairs' counts."""
    w = _words()
    out = triples.select("lang", "phrase", F.col("f").alias("a"), w[0].alias("x"), F.concat_ws(" ", w[1], w[2]).alias("yz"),
                         F.concat_ws(" ", w[0], w[1]).alias("xy"), w[2].alias("z"))
    for table, name, key in ((words, "x", "phrase"), (words, "z", "phrase"), (pairs, "xy", "phrase"), (pairs, "yz", "phrase")):
        out = out.join(table.select("lang", F.col(key).alias(name), F.col("f").alias(f"f_{name}")), ["lang", name])
    out = out.withColumns({"s1": _score("a", "f_x", "f_yz"), "s2": _score("a", "f_xy", "f_z")})
    second = F.col("s2") < F.col("s1")
    return out.select("lang", "phrase", "a", F.when(second, F.col("f_xy")).otherwise(F.col("f_x")).alias("l"),
                      F.when(second, F.col("f_z")).otherwise(F.col("f_yz")).alias("r"), F.least("s1", "s2").alias("score"), "xy", "yz", "f_xy", "f_yz")


def thresholds(scores: DataFrame, rank: int) -> DataFrame:
    """(lang, least): the score of the phrase of that rank in each language, 0 where there are fewer."""
    # at most a million and one rows a language, one for each score
    counts = scores.groupBy("lang", "score").agg(F.count("*").alias("n"))
    down = Window.partitionBy("lang").orderBy(F.desc("score"))
    return counts.withColumn("upto", F.sum("n").over(down)).groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("upto") >= rank, F.col("score"))), F.lit(0)).cast("long").alias("least"))


def frontier(pairs: DataFrame, levels: DataFrame) -> DataFrame:
    """The prefixes to expand: their bound reaches the language's threshold, or they settle whether a pair above it survives."""
    rows = pairs.join(levels, "lang")
    # of the pairs (w1, w2) above the threshold the rarest says how frequent (x, w1) must be to matter
    need = rows.where("score >= least").groupBy("lang", F.col("w1").alias("w2")).agg(F.min("a").alias("rarest"))
    rows = rows.join(need, ["lang", "w2"], "left")
    return rows.where(f"bound >= least or 100 * a >= {COVER_PERCENT} * rarest").select("lang", "phrase")


def survivors(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """Triples, and pairs that no triple of their words covers."""
    each = F.explode(F.array(F.struct(F.col("xy").alias("phrase"), F.col("f_xy").alias("f")), F.struct(F.col("yz").alias("phrase"), F.col("f_yz").alias("f"))))
    covered = (triples.select("lang", F.col("a").alias("longer"), each.alias("p")).where(f"100 * longer >= {COVER_PERCENT} * p.f")
               .select("lang", "p.phrase").distinct())
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    return pairs.join(covered, ["lang", "phrase"], "left_anti").select(*columns).unionByName(triples.select(*columns))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of two or three words of each language."""
    counted = materialise(ngrams(docs, 1).where(f"f >= {least} or phrase = ''"), "words")
    words, totals = counted.where("phrase != ''"), counted.where("phrase = ''").select("lang", F.col("f").alias("n"))
    known = bit_set(words, 1)
    counts = materialise(ngrams(docs, 2, (0, 1, known), (1, 1, known)).where(f"f >= {least}"), "pairs")
    pairs = materialise(scored_pairs(counts, words), "scored-pairs")
    known = bit_set(counts, 2)
    rank, levels, expanded, triples = FIRST_RANK * top, None, None, None
    while True:
        lower = thresholds(pairs, rank)
        if levels is not None:  # only languages that are not settled go on
            lower = lower.join(settled, "lang", "left").select("lang", F.coalesce("settled", "least").alias("least"))
        levels = materialise(lower, "levels")
        now = frontier(pairs, levels)
        new = materialise(now if expanded is None else now.join(expanded, ["lang", "phrase"], "left_anti"), "frontier")
        more = ngrams(docs, 3, (0, 2, bit_set(new, 2)), (1, 2, known)).where(f"f >= {least}")
        more = scored_triples(more, counts, words)
        triples = materialise(more if triples is None else triples.unionByName(more).dropDuplicates(["lang", "phrase"]), "triples")
        expanded = new if expanded is None else expanded.unionByName(new)
        whole = materialise(survivors(pairs, triples).join(levels, "lang").where("score >= least"), "survivors")
        enough = whole.groupBy("lang").agg(F.count("*").alias("found"))
        state = levels.join(enough, "lang", "left").where(f"least = 0 or found >= {top}")
        settled = materialise(state.select("lang", F.col("least").alias("settled")), "settled")
        if levels.join(settled, "lang", "left_anti").isEmpty():
            break
        rank *= RANK_GROWTH
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = whole.withColumn("rank", F.row_number().over(first).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (SELECT doc_id, lang, unnest(range(1, len(ps) + 1)) AS k, unnest(ps) AS piece FROM
             (SELECT row_number() OVER () AS doc_id, coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]') AS ps FROM documents)),
w AS (SELECT doc_id, lang, k, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM
        (SELECT doc_id, lang, k, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p)),
g AS (SELECT lang, w AS x, lead(w, 1) OVER s AS y, lead(w, 2) OVER s AS z FROM w WINDOW s AS (PARTITION BY doc_id, k ORDER BY i)),
u AS (SELECT lang, x, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL),
b AS (SELECT lang, x, y, CAST(count(*) AS HUGEINT) AS f FROM g WHERE y IS NOT NULL GROUP BY ALL),
t AS (SELECT lang, x, y, z, CAST(count(*) AS HUGEINT) AS f FROM g WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f) AS n FROM u GROUP BY lang),
b2 AS (SELECT b.lang, b.x, b.y, b.f AS a, u1.f AS l, u2.f AS r FROM b JOIN u u1 ON u1.lang = b.lang AND u1.x = b.x
       JOIN u u2 ON u2.lang = b.lang AND u2.x = b.y WHERE b.f >= 10),
t2 AS (SELECT t.lang, t.x, t.y, t.z, t.f AS a, u1.f AS l1, b1.f AS r1, b0.f AS l2, u3.f AS r2,
              1000000 * t.f * t.f // (u1.f * b1.f) AS s1, 1000000 * t.f * t.f // (b0.f * u3.f) AS s2
       FROM t JOIN u u1 ON u1.lang = t.lang AND u1.x = t.x JOIN b b1 ON b1.lang = t.lang AND b1.x = t.y AND b1.y = t.z
       JOIN b b0 ON b0.lang = t.lang AND b0.x = t.x AND b0.y = t.y JOIN u u3 ON u3.lang = t.lang AND u3.x = t.z),
c AS (SELECT lang, x || ' ' || y || ' ' || z AS phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END AS l, CASE WHEN s2 < s1 THEN r2 ELSE r1 END AS r, least(s1, s2) AS score FROM t2
      UNION ALL
      SELECT lang, x || ' ' || y, a, l, r, 1000000 * a * a // (l * r) FROM b2
      WHERE NOT EXISTS (SELECT 1 FROM t2 WHERE t2.lang = b2.lang AND t2.x = b2.x AND t2.y = b2.y AND 100 * t2.a >= 50 * b2.a)
        AND NOT EXISTS (SELECT 1 FROM t2 WHERE t2.lang = b2.lang AND t2.y = b2.x AND t2.z = b2.y AND 100 * t2.a >= 50 * b2.a)),
k AS (SELECT c.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM k JOIN n ON n.lang = k.lang WHERE rank <= 2000"""
