"""Filter interaction audit: what each filter removes in every order of the filters.

Each document is reduced to the letters of the filters it fails, and documents
to cells (part, letters) with weights: rows, good rows, toxic rows.  A part has
at most 32 cells however many documents it has.  A cell folds across the array
of all 120 orders: ``aggregate`` finds the step that removes it, ``transform``
turns its weights into one struct per order and step, 600 in all; the structs
of a part's cells are summed element by element.

Whether a text is a copy is decided without a join of documents: rows of one
text, part and letters are counted with their smallest id, and the smallest id
of the text follows from those counts; a text that a third of the rows share is
summed before it is shuffled.

Defined results: a null text is the empty text; a null lang is the part of the
empty string; a row without doc_id is no copy of any other and has no label;
rows that repeat an id count one by one and are no copies of each other;
several labels of one id count as quality 1 or toxic 1 if one of them says so;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismiq.llm.common import text_or_empty

FILTERS = "ABCDE"
#: Fixed values of the filters: least words, least share of distinct words and most of capitals in percent, symbols.
LEAST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 200, 50, 3, "[#$%&*|]"
WORD_BREAKS, COPY = r"[\x20\x09-\x0D]+", "E"
WEIGHTS = ("n", "good", "toxic")
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _letter(letter: str, fails: Column) -> Column:
    return F.when(fails, F.lit(letter)).otherwise(F.lit(""))


def text_fails(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, fails: the letters of the filters on the text itself that it fails."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text_or_empty().alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", WORD_BREAKS), ""))
    words, capitals = F.size("words"), F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), F.concat(
        _letter("A", words < LEAST_WORDS),
        _letter("B", 100 * F.size(F.array_distinct("words")) < DISTINCT_PERCENT * words),
        _letter("C", 100 * capitals > CAPITALS_PERCENT * F.length("text")),
        _letter("D", F.col("text").rlike(SYMBOLS))).alias("fails"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows counted by all their columns, with what the labels say of their id (0 where nothing)."""
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))])
    known = rows.where("doc_id is not null").groupBy(*rows.columns).agg(F.count("*").alias("n")).join(said, "doc_id", "left")
    bare = rows.where("doc_id is null").groupBy(*rows.columns).agg(F.count("*").alias("n"))
    zero = F.lit(None).cast("int")
    return known.unionByName(bare.withColumns({"good": zero, "toxic": zero})).fillna(0, ["good", "toxic"])


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails, n, good, toxic: documents by part and failed filters."""
    rows = labelled(text_fails(docs), labels)
    alike = rows.where("doc_id is not null").groupBy("digest", "part", "fails").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(w)).alias(w) for w in WEIGHTS[1:]],
        F.min(F.struct("doc_id", "n", "good", "toxic")).alias("first"))
    alike = alike.withColumn("lowest", F.min("first.doc_id").over(Window.partitionBy("digest")))
    original = F.col("first.doc_id") == F.col("lowest")
    own = {"n": F.col("first.n")} | {w: F.col("first.n") * F.col(f"first.{w}") for w in WEIGHTS[1:]}
    own = {w: F.when(original, c).otherwise(0) for w, c in own.items()}
    kinds = F.array(F.struct("fails", *[own[w].alias(w) for w in WEIGHTS]),
                    F.struct(F.concat("fails", F.lit(COPY)).alias("fails"), *[(F.col(w) - own[w]).alias(w) for w in WEIGHTS]))
    told = alike.select("part", F.explode(kinds).alias("k")).select("part", "k.*").where("n > 0")
    bare = rows.where("doc_id is null").select("part", "fails", "n", *[F.lit(0).cast("long").alias(w) for w in WEIGHTS[1:]])
    return told.unionByName(bare).groupBy("part", "fails").agg(*[F.sum(w).alias(w) for w in WEIGHTS])


def folded(cell: DataFrame) -> DataFrame:
    """The 600 weighted structs of every cell, one for each order and step."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps, fails = F.sequence(F.lit(1), F.lit(len(FILTERS))), F.col("fails")

    def weighted(order: Column) -> Column:
        def hit(step: Column) -> Column:
            return F.contains(fails, F.substring(order, step, F.lit(1)))

        gone = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at == 0) & hit(step), step).otherwise(at))

        def struct(step: Column) -> Column:
            def told(when: Column, weight: str) -> Column:
                return F.when(when, F.col(weight)).otherwise(F.lit(0).cast("long"))

            here = step == gone
            return F.struct(
                order.alias("filter_order"), step.alias("step"),
                told((gone == 0) | (step < gone), "n").alias("kept"), told(here, "n").alias("removed"),
                told((gone > 0) & (step > gone) & hit(step), "n").alias("redundant"),
                told(fails == F.substring(order, step, F.lit(1)), "n").alias("unique_fails"),
                told(here, "good").alias("good_lost"), told(here, "toxic").alias("toxic_lost"))

        return F.transform(steps, struct)

    return cell.select("part", F.flatten(F.transform(orders, weighted)).alias("structs"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    each = folded(cells(docs, labels)).select("part", F.explode("structs").alias("s")).select("part", "s.*")
    sums = each.groupBy("part", "filter_order", "step").agg(*[F.sum(m).cast("long").alias(m) for m in MEASURES])
    # a part has 120 rows of each filter, whatever the number of its documents
    same_filter = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return sums.withColumn("shapley", F.sum("removed").over(same_filter))


ORACLE = r"""
WITH d AS (SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
w AS (SELECT *, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS lowest FROM d),
m AS (SELECT part, good, toxic, concat(
          CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END,
          CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
          CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
          CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
          CASE WHEN doc_id > lowest THEN 'E' ELSE '' END) AS fails FROM w),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT concat(x1.f, x2.f, x3.f, x4.f, x5.f) AS filter_order FROM x x1, x x2, x x3, x x4, x x5
      WHERE len(list_distinct([x1.f, x2.f, x3.f, x4.f, x5.f])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
g AS (SELECT c.part, c.fails, c.n, c.good, c.toxic, s.filter_order, s.step, s.f,
             min(CASE WHEN contains(c.fails, s.f) THEN s.step END) OVER (PARTITION BY c.part, c.fails, s.filter_order) AS gone FROM c, s),
r AS (SELECT part, filter_order, step, f,
        sum(CASE WHEN gone IS NULL OR step < gone THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN step = gone THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN step > gone AND contains(fails, f) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN step = gone THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN step = gone THEN toxic ELSE 0 END) AS toxic_lost FROM g GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""
