"""Personal data: base patterns as seeds, bootstrapped contextual extraction beyond them.

DataFrame functions only.  Spans of a pattern come from two built-in functions:
the matches (``regexp_extract_all``) and what lies between them (``split``);
running sums of their lengths are the offsets, in code points.  The patterns are
written so that the regular expression engine needs linear time on any text:
quantifiers are possessive where what follows cannot be part of the run, and a
match never begins inside a run that an earlier position has already tried.

Bootstrapping: each base span is an instance of its kind; a quoted value that
is assigned (``token = "..."``) and looks random is an instance of a fifth kind,
``secret``.  Each other token that looks like an identifier (a ``@``, or four
digits) and each longest run of digit groups of 4 digits or more is an
unlabelled instance.  The two words of the text before an instance, and the last
of them alone, are its lexical patterns; of a word its last 24 characters count.
Patterns and instances are the two sides of a graph.  In each round Spark scores
a pattern by the share of labelled instances among its distinct instances, and
an instance by the noisy-or of its patterns; rounds go on until none finds more.

A sure instance is labelled, and marked wherever it stands, if at least half of
its occurrences have a confident pattern.  One that mostly stands elsewhere (a
year that was once written after "call") is no new seed and is marked only where
its own pattern is confident.

Defined results: a null text is empty; an empty text has no spans; repeated
rows give equal results; matches that fail a check (address part over 255, Luhn,
number of digits) are dropped without retry; spans of different kinds may
overlap; added spans never overlap a base span, but a token may lie in a run; a
secret that is a seed in one place is marked in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import freed_shuffles, materialise, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The kinds of base spans, and those that only the method adds.
ALL_KINDS = (*KINDS, "secret")
SECRET = len(KINDS)
#: The base patterns.  Not inside a run: \\G is the end of the previous match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Tokens that may be identifiers: runs of non-blanks that hold a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Numbers written in groups, joined by blanks, brackets, dots or hyphens.
GROUPS = r"(?<![0-9])\+?+(?:[(\[][0-9]++[)\]]|[0-9]++)(?:[\x20()\[\].-]{1,3}+[0-9]++)++"
#: A seed of the kind secret: a quoted token, what is inside the quotes, the text before it.
QUOTED, RANDOM, ASSIGNED = r"^[\"'`][A-Za-z0-9_/+=.-]{20,}+[\"'`]", r"^(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9_/+=.-]{20,}+$", r"[=:]\s*$"
#: A pattern needs so many distinct labelled instances, this share of all; an instance this belief, and that share of its occurrences.
LEAST_SUPPORT, LEAST_SHARE, LEAST_BELIEF = 3, 0.5, 0.8
#: The characters of a word that count, and of squeezed text that hold two words and more.
WORD_CHARS, CONTEXT_CHARS = 24, 64


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _squeezed(before: Column) -> Column:
    """The end of the text before a match: blanks as one, of a word its last characters.  Squeezing piece by piece gives the same."""
    cut = F.regexp_replace(F.regexp_replace(before, r"\s+", " "), rf"\S*(\S{{{WORD_CHARS}}})(?!\S)", "$1")
    return F.right(cut, F.lit(CONTEXT_CHARS))


def _spans(text: Column, pattern: str) -> Column:
    """All matches: struct(start, end, value, before), leftmost and non-overlapping; ``before`` is the text's end before a match."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def add(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["between"])
        end = start + F.length(m["found"])
        before = _squeezed(F.concat(acc["tail"], m["between"]))
        span = F.struct(start.alias("start"), end.alias("end"), m["found"].alias("value"), before.alias("before"))
        tail = _squeezed(F.concat(before, m["found"]))
        return F.struct(end.alias("at"), tail.alias("tail"), F.array_append(acc["spans"], span).alias("spans"))

    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")
    zipped = F.arrays_zip(found.alias("found"), F.slice(between, F.lit(1), F.size(found)).alias("between"))
    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), empty.alias("spans")), add, lambda acc: acc["spans"])


def with_base(docs: DataFrame, text: str = "text", column: str = "base") -> DataFrame:
    """Add the base spans: array of struct(start, kind number, end, value, before), in order."""
    t = text_or_empty(text)
    digit = t.rlike("[0-9]")
    may = {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+")) & digit}
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string,before:string>>")

    def of(n: int, kind: str) -> Column:
        checked = F.filter(_spans(t, PATTERNS[kind]), lambda s: _holds(kind, s["value"]))
        return F.transform(checked, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end"),
                                                       s["value"].alias("value"), s["before"].alias("before")))

    parts = [F.when(may.get(kind, digit), of(n, kind)).otherwise(none) for n, kind in enumerate(KINDS)]
    return docs.withColumn(column, F.array_sort(F.concat(*parts)))


def _tokens(text: Column, base: Column) -> Column:
    """Identifier-like tokens, without quotes and stops around them, and runs of digit groups outside the base spans.

    ``kind`` is that of a seed, else null.
    """
    edge = "\"'`<>()\\[\\]{},;:!?.#$%&*|"

    def trimmed(s: Column) -> Column:
        left = F.regexp_replace(s["value"], f"^[{edge}]+", "")
        core = F.regexp_replace(left, f"[{edge}=]+$", "")
        start = s["start"] + F.length(s["value"]) - F.length(left)
        seed = core.rlike(RANDOM) & (F.length(F.regexp_replace(core, "[^0-9]", "")) >= 4) & s["value"].rlike(QUOTED) & s["before"].rlike(ASSIGNED)
        return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("value"), s["before"].alias("before"),
                        F.when(seed, SECRET).alias("kind"))

    def unlabelled(s: Column) -> Column:
        return F.struct(*[s[c].alias(c) for c in ("start", "end", "value", "before")], F.lit(None).cast("int").alias("kind"))

    digits = lambda s: F.length(F.regexp_replace(s["value"], "[^0-9]", ""))
    looks = lambda s: F.contains(s["value"], F.lit("@")) | (digits(s) >= 4)
    free = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string,kind:int>>")
    single = F.when(text.rlike("[0-9@]"), F.filter(F.transform(_spans(text, TOKEN), trimmed), looks)).otherwise(none)
    runs = F.when(text.rlike(GROUPS), F.transform(F.filter(_spans(text, GROUPS), lambda s: digits(s) >= 4), unlabelled)).otherwise(none)
    # a number such as 555-0199 is both: the same span and the same text before it
    return F.filter(F.array_union(single, runs), free)


def _contexts(before: Column, value: Column) -> Column:
    """The lexical patterns of an instance: the one and the two words before it, with a sign for its sort."""
    words = F.filter(F.split(F.regexp_replace(F.lower(before), "[0-9]", "9"), r"\s+"), lambda w: w != "")
    last = lambda n: F.array_join(F.slice(words, F.size(words) - n + 1, F.lit(n)), " ")
    sort = F.when(F.contains(value, F.lit("@")), F.lit(" _@")).otherwise(F.lit(" _9"))
    return F.filter(F.array(F.when(F.size(words) >= 1, F.concat(last(1), sort)), F.when(F.size(words) >= 2, F.concat(last(2), sort))),
                    lambda p: p.isNotNull())


def bootstrap(occurrences: DataFrame, rounds: int | None = None) -> DataFrame:
    """(value, kind, pattern) of discovered identifiers, from (value, kind or null, pattern) occurrences.

    A null pattern: the value is an identifier wherever it stands; else only
    after this pattern.  One edge for each pattern and instance, however often
    they meet.  A pattern's score and an instance's belief are aggregates with
    map-side partial sums.  ``rounds`` bounds the rounds; without it they go on
    until one finds nothing new.
    """
    edges = materialise(occurrences.groupBy("pattern", "value").agg(F.min("kind").alias("kind"), F.count("*").alias("times")), "edges")
    known = edges.where("kind is not null").groupBy("value").agg(F.min("kind").alias("kind"))
    found, done = edges.select("value", "kind", "pattern").limit(0), 0
    while rounds is None or done < rounds:
        done += 1
        labelled = edges.drop("kind").join(known, "value", "left")
        per_kind = [F.count_if(F.col("kind") == n).alias(f"k{n}") for n in range(len(ALL_KINDS))]
        counts = labelled.groupBy("pattern").agg(F.count("*").alias("n"), *per_kind)
        support = F.greatest(*[f"k{n}" for n in range(len(ALL_KINDS))])
        kind = F.coalesce(*[F.when(F.col(f"k{n}") == support, n) for n in range(len(ALL_KINDS))])
        # support tempers the share of a pattern seen only a few times
        share = support / F.col("n")
        confident = (counts.where((support >= LEAST_SUPPORT) & (share >= LEAST_SHARE))
                     .select("pattern", kind.alias("kind"), (share * support / (support + 1)).alias("weight")))
        seen = labelled.where("kind is null").drop("kind").join(confident, "pattern", "left")
        belief = 1 - F.exp(F.sum(F.log(1 - F.col("weight"))))
        by_kind = seen.groupBy("value", "kind").agg(belief.alias("belief"), F.sum("times").alias("times"))
        best = by_kind.groupBy("value").agg(F.sum("times").alias("all"), F.max(F.when(F.col("kind").isNotNull(), F.struct(
            "belief", (-F.col("kind")).alias("minus"), "times"))).alias("b"))
        sure = materialise(best.where(F.col("b.belief") >= LEAST_BELIEF).select(
            "value", (-F.col("b.minus")).alias("kind"), (F.col("b.times") >= LEAST_SHARE * F.col("all")).alias("mostly")), "sure")
        new = sure.where("mostly").select("value", "kind")
        if new.isEmpty():
            break
        found = found.union(new.withColumn("pattern", F.lit(None).cast("string")))
        known = known.union(new)
    else:
        if not done:
            return found
    here = seen.join(sure.where("not mostly").select("value", "kind"), ["value", "kind"]).select("value", "kind", "pattern")
    return found.union(here)


def find(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """One row per document: doc_id, text_key, base and added spans.

    ``spans`` has all, in order; elements are struct(start, kind, end).
    """
    keyed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    based = with_base(keyed)
    marked = materialise(based.withColumn("tokens", _tokens(F.col("text"), F.col("base"))).drop("text"), "marked")
    added = _added(marked, rounds)
    bare = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    rows = marked.select("doc_id", "text_key", F.transform("base", bare).alias("base"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if added is None:
        return rows.withColumn("added", none).withColumn("spans", F.col("base"))
    a = added.alias("a")
    r = rows.alias("r")
    j = r.join(a, F.col("r.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("r.text_key") == F.col("a.text_key")), "left")
    extra = F.coalesce(F.col("a.added"), none)
    return j.select(F.col("r.doc_id").alias("doc_id"), F.col("r.text_key").alias("text_key"), F.col("base"), extra.alias("added"),
                    F.array_sort(F.concat("base", extra)).alias("spans"))


def _added(marked: DataFrame, rounds: int | None) -> DataFrame | None:
    """(doc_id, text_key, added): the spans of discovered identifiers; None if there are none."""
    with freed_shuffles(marked.sparkSession):
        seeds = marked.select(F.explode("base").alias("s")).select("s.value", "s.kind", "s.before")
        tokens = marked.select("doc_id", "text_key", F.explode("tokens").alias("s")) \
            .select("doc_id", "text_key", "s.start", "s.end", "s.value", "s.before", "s.kind")
        occurrences = seeds.union(tokens.select("value", "kind", "before"))
        pattern = F.explode(_contexts(F.col("before"), F.col("value"))).alias("pattern")
        found = bootstrap(occurrences.select("value", "kind", pattern), rounds)
        secrets = tokens.where("kind is not null").select("value", "kind").distinct().withColumn("pattern", F.lit(None).cast("string"))
        found = materialise(found.union(secrets), "found")
        if found.isEmpty():
            return None
        free = tokens.drop("kind")
        marks = free.join(found.where("pattern is null"), "value").select("doc_id", "text_key", "start", "kind", "end")
        here = (free.select("doc_id", "text_key", "start", "end", "value", pattern).join(found, ["value", "pattern"])
                .select("doc_id", "text_key", "start", "kind", "end"))
        spans = marks.union(here).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("added"))
        return materialise(spans, "added")


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redact(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """The documents with every span, base and added, replaced by its kind in brackets.

    Of overlapping spans the first (by start, then kind) gives the name; the rest
    of their union goes with it.  ``n_chars`` follows the new text; documents
    without spans stay as they are.
    """
    spans = find(docs, rounds).where(F.size("spans") > 0).select("doc_id", "text_key", "spans").dropDuplicates(["doc_id", "text_key"])
    spans = spans.toDF("found_id", "found_key", "found_spans")
    # own names by position, so that no column of the table can clash
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.toDF(*own.values()).withColumn("key", F.xxhash64(text_or_empty(own["text"])))
    j = keyed.join(spans, F.col(own["doc_id"]).eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key")), "left")
    t, names = text_or_empty(own["text"]), F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])

    def cut(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    clean = F.aggregate("found_spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), cut,
                        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.lit(2**31 - 1) - acc["at"] - 1)))
    has = F.col("found_spans").isNotNull()
    out = j.withColumn("clean", F.when(has, clean).otherwise(F.col(own["text"])))
    new = {"text": F.col("clean")}
    if "n_chars" in own:
        new["n_chars"] = F.when(has, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(own["n_chars"]))
    return out.select(*[new.get(c, F.col(n)).alias(c) for c, n in own.items()])
