"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

DataFrame functions only.  A text's elements are its paragraphs: lines, long
ones in runs of 16 words; an element is a 64-bit hash of a paragraph and of how
often it occurs.  A sketch is dealt by hash to sub-sketches of a few elements
each; every element is added to three cells of its sub-sketch: a count, the xor
of elements and the xor of their check hashes.  The sketches of two versions are
subtracted cell by cell, which leaves the elements they do not share, and these
are recovered by peeling: a cell that holds one element gives it away, it is
taken out of its other cells, and so on.  A sub-sketch that does not peel is
retried with twice the cells, up to the last size; what even that cannot peel
is compared element by element (``array_except``).  The likeness of two versions
is the number of shared elements over that of all.

The printed fingerprint is a four-cell sketch of the whole text: for each cell
the count, the xor of elements and the xor of checks.

Neighbours (for the edited texts) come from a range partitioning of the keys
alone: the next row of the partition, or the first one of the next.  Documents
are keyed by id and hash of the text, so a hot id is spread by its texts.

Defined results: a null text is empty; an empty text has no elements, and two
such texts have likeness 1; documents without an id come first; documents of the
same id follow by the hash of their text; rows that repeat count as one document
for the order and are repeated in the result; the only document is its own next;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismiq.llm.common import materialise, sha256_hex, text_or_empty

#: A run of at most 16 words within a line.
PARAGRAPH = r"(?:[^\s]++[^\S\n]*+){1,16}+"
#: Elements of a sub-sketch (mean), its cells at first and at each retry; the cells of one element.
MEAN_ELEMENTS, CELLS, HASHES = 4, (12, 24, 48, 96), 3
PRINTED_CELLS = 4


def paragraphs(text: Column) -> Column:
    """Hashes of a text's paragraphs, repeats included."""
    return F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(F.rtrim(p)))


def _check(element: Column) -> Column:
    return F.xxhash64(F.lit("check"), element)


def _cell(element: Column, j: int, cells: int) -> Column:
    """The j-th of an element's cells: each third of the sketch has one."""
    third = cells // HASHES
    return F.pmod(F.xxhash64(F.lit(f"cell{j}"), element), F.lit(third)).cast("int") + j * third


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(elements: Column) -> Column:
    """A cell with these: struct(n, key, check) added up."""
    return F.aggregate(elements, F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check")),
                       lambda a, p: F.struct((a["n"] + p["n"]).alias("n"), a["key"].bitwiseXOR(p["key"]).alias("key"),
                                             a["check"].bitwiseXOR(p["check"]).alias("check")))


def _placed(element: Column, n: Column, check: Column, cells: int) -> Column:
    return F.struct(n.alias("n"), element.alias("key"), check.alias("check"),
                    F.array(*[_cell(element, j, cells) for j in range(HASHES)]).alias("at"))


def sketch(elements: Column, cells: int) -> Column:
    """An array of cells: struct(n, key, check)."""
    return _let(F.transform(elements, lambda e: _placed(e, F.lit(1), _check(e), cells)), lambda placed: F.transform(
        F.sequence(F.lit(0), F.lit(cells - 1)), lambda i: _sum(F.filter(placed, lambda p: F.array_contains(p["at"], i)))))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"),
                                                  x["check"].bitwiseXOR(y["check"]).alias("check")))


def peel(difference: Column, cells: int) -> Column:
    """The elements in one version only; null if the sketch is too small to recover them all."""
    def pure(state: Column) -> Column:
        return F.array_distinct(F.transform(
            F.filter(state, lambda c: ((c["n"] == 1) | (c["n"] == -1)) & (c["check"] == _check(c["key"]))),
            lambda c: _placed(c["key"], c["n"], c["check"], cells)))

    def without(state: Column, gone: Column) -> Column:
        def less(c: Column, i: Column) -> Column:
            out = _sum(F.filter(gone, lambda p: F.array_contains(p["at"], i)))
            return _let(out, lambda o: F.struct((c["n"] - o["n"]).alias("n"), c["key"].bitwiseXOR(o["key"]).alias("key"),
                                                c["check"].bitwiseXOR(o["check"]).alias("check")))
        return F.transform(state, less)

    def state(cells_left: Column, found: Column) -> Column:
        return _let(cells_left, lambda c: F.struct(c.alias("cells"), found.alias("found"), pure(c).alias("gone")))

    def step(acc: Column, _: Column) -> Column:
        found = F.concat(acc["found"], F.transform(acc["gone"], lambda p: p["key"]))
        return F.when(F.size(acc["gone"]) == 0, acc).otherwise(state(without(acc["cells"], acc["gone"]), found))

    def end(acc: Column) -> Column:
        empty = F.forall(acc["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0))
        return F.when(empty, acc["found"])

    # each round takes out one element at least
    start = state(difference, F.array().cast("array<bigint>"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(cells)), start, step, end)


def differing(a: Column, b: Column, first: Column | None = None) -> Column:
    """How many elements two lists do not share: by sketches that grow until one peels.

    ``first``: the difference of their smallest sketches, if it is at hand.
    """
    def counted(found: Column) -> Column:
        return F.when(found.isNotNull(), F.size(found))

    differences = [subtract(sketch(a, m), sketch(b, m)) for m in CELLS]
    if first is not None:
        differences[0] = first
    tries = [_let(peel(d, m), counted) for d, m in zip(differences, CELLS)]
    return F.coalesce(*tries, F.size(F.array_except(a, b)) + F.size(F.array_except(b, a)))


def _neighbours(keys: DataFrame) -> DataFrame:
    """keys (id, key, n_chars, copies) with next_id and next_key, in the order of (id, key)."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(keys.repartitionByRange(parts, "id", "key").withColumn("part", F.spark_partition_id()), "keys")
    me = F.struct("id", "key")
    inside = ranged.withColumn("next", F.lead(me).over(Window.partitionBy("part").orderBy("id", "key")))
    # one row for each partition: the first of the next one; after the last the first of all
    firsts, order = ranged.groupBy("part").agg(F.min(me).alias("f")), Window.orderBy("part")
    last = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("f").over(order), F.first("f").over(last)).alias("after"))
    found = F.coalesce("next", "after")
    return inside.join(after, "part").select("id", "key", "n_chars", "copies", found["id"].alias("next_id"), found["key"].alias("next_key"))


def versions(docs: DataFrame) -> DataFrame:
    """For each document: paragraph hashes of its text (p0), its edited text (p1) and the next document's (p2).

    Rows that repeat are one row here, with their number in ``copies``.
    """
    no_id = F.lit(-(1 << 63)).cast("long")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("id"), F.xxhash64(text_or_empty()).alias("key"),
                        text_or_empty().alias("text"))
    order = _neighbours(keyed.groupBy("id", "key").agg(F.max(F.length("text")).alias("n_chars"), F.count("*").alias("copies")))
    # both joins read the same three columns by the same key: one exchange of the texts serves them
    texts = keyed.dropDuplicates(["id", "key"])
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    given = (texts.join(order.select(F.col("next_id").alias("id"), F.col("next_key").alias("key"), F.col("id").alias("own_id"),
                                     F.col("key").alias("own_key"), "n_chars", "copies"), ["id", "key"])
             .select(F.col("own_id").alias("id"), F.col("own_key").alias("key"), "n_chars", "copies",
                     F.substring("text", F.lit(1), cut).alias("given"), paragraphs(F.col("text")).alias("p2")))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - cut), F.col("given"))
    return (texts.join(given, ["id", "key"]).withColumn("edited", edited)
            .select("id", "key", F.when(F.col("id") != no_id, F.col("id")).alias("doc_id"), "n_chars", "copies", sha256_hex(F.col("edited")).alias("edited_sha256"),
                    paragraphs(F.col("text")).alias("p0"), paragraphs(F.col("edited")).alias("p1"), "p2"))


def _printed(elements: Column, names: str) -> list[Column]:
    """Partial sums of the printed cells of one sub-sketch's elements."""
    out = []
    for i in range(PRINTED_CELLS):
        own = F.filter(elements, lambda e: F.pmod(e, F.lit(PRINTED_CELLS)) == F.lit(i))  # noqa: B023  called at once
        out += [F.size(own).alias(f"{names}n{i}"), _xor(own).alias(f"{names}k{i}"),
                _xor(F.transform(own, _check)).alias(f"{names}c{i}")]
    return out


def _fingerprint(names: str) -> Column:
    """The printed cells: count:keys:checks, in hexadecimal, missing values as zero."""
    zero = lambda c: F.lower(F.hex(F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))))
    return F.concat_ws("-", *[F.concat_ws(":", *[zero(f"{names}{x}{i}") for x in "nkc"]) for i in range(PRINTED_CELLS)])


def _alike(a: str, b: str, d: str) -> Column:
    """Shared elements over all elements."""
    total = F.coalesce(F.col(a) + F.col(b), F.lit(0))
    return F.when(total == 0, 1.0).otherwise((total - F.col(d)) / (total + F.col(d)))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    From the exchange by document on, every step groups within a document, so no
    further exchange of elements is needed.
    """
    made = materialise(versions(docs), "versions")
    parts = int(made.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = F.greatest(F.lit(1), *[F.size(f"p{v}") for v in range(3)])
    groups = F.ceil(most / MEAN_ELEMENTS).cast("long")
    hashes = (made.select("id", "key", groups.alias("groups"), "p0", "p1", "p2").repartition(parts, "id", "key")
              .select("id", "key", "groups", F.posexplode(F.array("p0", "p1", "p2")).alias("v", "hs"))
              .select("id", "key", "groups", "v", F.explode("hs").alias("h")))
    # an element: a paragraph and its number of occurrences
    elements = (hashes.groupBy("id", "key", "groups", "v", "h").agg(F.count("*").alias("n"))
                .select("id", "key", "groups", "v", F.xxhash64("h", "n").alias("e")))
    lists = [F.collect_list(F.when(F.col("v") == v, F.col("e"))).alias(f"e{v}") for v in range(3)]
    dealt = elements.groupBy("id", "key", F.pmod(F.xxhash64(F.lit("group"), "e"), "groups").alias("g")).agg(*lists)
    small = dealt.withColumns({f"k{v}": sketch(F.col(f"e{v}"), CELLS[0]) for v in range(3)})
    unlike = {f"d{v}": differing(F.col("e0"), F.col(f"e{v}"), subtract(F.col("k0"), F.col(f"k{v}"))) for v in (1, 2)}
    compared = small.select("id", "key", *[F.size(f"e{v}").alias(f"s{v}") for v in range(3)], *[c.alias(n) for n, c in unlike.items()],
                            *_printed(F.col("e0"), "x"), *_printed(F.col("e1"), "y"))
    sums = [F.sum(c).alias(c) for c in ("s0", "s1", "s2", "d1", "d2", *[f"{x}n{i}" for x in "xy" for i in range(PRINTED_CELLS)])]
    xors = [F.bit_xor(f"{x}{f}{i}").alias(f"{x}{f}{i}") for x in "xy" for f in "kc" for i in range(PRINTED_CELLS)]
    found = compared.groupBy("id", "key").agg(*sums, *xors)
    rows = made.select("id", "key", "doc_id", "n_chars", "copies", "edited_sha256").join(found, ["id", "key"], "left")
    out = rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", _fingerprint("x").alias("fingerprint"),
                      _fingerprint("y").alias("edited_fingerprint"), _alike("s0", "s1", "d1").alias("near_edited"),
                      _alike("s0", "s2", "d2").alias("near_next"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return out.drop("copy")
