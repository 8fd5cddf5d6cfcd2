"""Quality classifier by co-training.

Two views of a document: its text (character classes, repetition, line and word
shape, and which telling words it holds) and its metadata (language, source,
declared length).  A label is bad if its quality is 0 or it is toxic.  A logistic
regression for each view is fitted on the labelled documents; in every round
each view labels the unlabelled documents it is sure of for the other view's
next fit, where they weigh no more than the labelled ones of their class.  Both
are then calibrated on labelled documents kept out of all fits (Platt scaling),
and the calibrated log odds add up, less the prior that both hold, to the score
of every document.

A telling word is one whose presence depends on the label (chi-square over the
labelled documents); the ``max_words`` most telling ones are features as they
stand, without hashing, so no other word can be taken for one.  A word is a
lower-cased run of letters and digits of at most 40 characters; the beginnings
of longer words (4 to 8 characters, written with an asterisk) count as words of
their own, so that endings never seen with a label are known by their stem.

The fits use at most ``max_labelled`` labelled documents, those of the smallest
hash of their id: a documented bound.  All other documents are unlabelled ones.
Features, pseudo-labels and scores cover every document and every whole text.

Defined results: a null text is the empty text; missing metadata is a category
of its own; labels of one doc_id that disagree count as the lowest; a label
without quality counts only if toxic; documents without an id are scored but
never used for fitting; if the labels hold fewer than two classes every document
scores 0.5 and is kept; repeated rows get equal scores; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, FeatureHasher, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, materialise, slices, text_or_empty

MAX_LABELLED, MAX_WORDS, ROUNDS, SURE = 20_000, 2_000, 3, 0.95
#: A telling word stands in so many labelled documents, has this chi-square and no more characters than that.
LEAST_DOCS, LEAST_CHI, WORD_CHARS = 5, 20.0, 40
#: The lengths of a word's beginnings.
STEMS = range(4, 9)
META_SIZE = 64
#: Byte classes: 0 lower case and other, 1 upper case, 2 digit, 3 line end, 4 blank, 5 stop, 6 call or question, 7 symbol, 8 quote or bracket.
_CLASS = np.zeros(256, np.uint8)
for _n, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\n\r", b" \t", b".,;:", b"!?", b"#$%&*|~^_=+<>@\\/`", b"\"'()[]{}"), 1):
    _CLASS[list(_chars)] = _n
N_FEATURES = 15
_WORD = re.compile(r"[^\W_]+")
_OWN = ("__shape", "__words", "__shape_vector", "__word_vector", "__lang", "__source", "__length", "__text_view", "__meta_view", "__t", "__m")


def text_features(data: bytes) -> list[float]:
    """Shares and logarithms that describe a text's shape; all 0 for an empty text."""
    if not data:
        return [0.0] * N_FEATURES
    n = len(data)
    shares = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=9) / n
    words, lines = data.split(), data.split(b"\n")
    w = max(1, len(words))
    repeats = sum(map(bytes.__eq__, words, words[1:])) / w
    return [*map(float, shares[1:]), len(set(words)) / w, repeats, math.log1p(w), n / w / 10,
            math.log1p(w / len(lines)), len(set(lines)) / len(lines), len(max(words, key=len, default=b"")) / 50]


def text_words(text: str) -> set[str]:
    """The distinct words of a whole text."""
    return {w for w in _WORD.findall(" ".join(set(text.lower().split()))) if len(w) <= WORD_CHARS}


def text_terms(text: str) -> set[str]:
    """The distinct words of a whole text and their beginnings."""
    words = text_words(text)
    return words.union(f"{w[:k]}*" for w in words for k in STEMS if len(w) > k)



def _terms() -> Column:
    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = (sorted(text_terms(t)) for part in slices(texts) for t in part.to_pylist())
            yield pa.array(list(rows), pa.list_(pa.string()))
    return run(text_or_empty())


def _features(words: tuple[str, ...]) -> Column:
    """struct(shape, words): the shape of a text and those of ``words`` that it holds."""
    wanted = frozenset(words)
    stems = frozenset(w[:-1] for w in words if w.endswith("*"))
    first = STEMS[0]
    heads = frozenset(w[:first] for w in stems)
    kind = pa.struct([("shape", pa.list_(pa.float64())), ("words", pa.list_(pa.string()))])

    def held(text: str) -> list[str]:
        own = text_words(text)
        # few words begin like a wanted stem: only their beginnings are built
        begun = {w[:k] for w in own if len(w) > first and w[:first] in heads for k in STEMS if len(w) > k}
        return sorted((own & wanted).union(f"{w}*" for w in begun & stems))

    @F.arrow_udf("struct<shape:array<double>,words:array<string>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = ({"shape": text_features(t.encode()), "words": held(t) if wanted else []}
                    for part in slices(texts) for t in part.to_pylist())
            yield pa.array(list(rows), kind)
    return run(text_or_empty())


def with_views(docs: DataFrame, words: tuple[str, ...] = ()) -> DataFrame:
    """Add ``__text_view`` and ``__meta_view``, the feature vectors of the two views."""
    docs = docs.drop(*_OWN)

    def meta(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in docs.columns else F.lit(None).cast(kind)

    out = bounded_batches(docs).withColumn("__words", _features(words))
    # the size as metadata, or the assembler would run a job to see a first row
    shape = array_to_vector("__words.shape").alias("__shape_vector", metadata={"ml_attr": {"num_attrs": N_FEATURES}})
    out = out.select("*", shape).withColumns({"__words": F.col("__words.words"),
                           "__lang": F.coalesce(meta("lang", "string"), F.lit("")),
                           "__source": F.coalesce(meta("source", "string"), F.lit("")),
                           "__length": F.log1p(F.greatest(F.coalesce(meta("n_chars", "double"), F.lit(0.0)), F.lit(0.0)))})
    if words:
        # a model made anew for each call: the vocabulary is its state
        held = CountVectorizerModel.from_vocabulary(list(words), "__words", "__word_vector", binary=True)
        out = VectorAssembler(inputCols=["__shape_vector", "__word_vector"], outputCol="__text_view").transform(held.transform(out))
    else:
        out = out.withColumn("__text_view", F.col("__shape_vector"))
    hasher = FeatureHasher(inputCols=["__lang", "__source", "__length"], outputCol="__meta_view", numFeatures=META_SIZE)
    return hasher.transform(out).drop("__lang", "__source", "__length", "__words", "__shape_vector", "__word_vector")


def _odds(model: LogisticRegressionModel, frame: DataFrame, column: str) -> DataFrame:
    """Add the log odds of class 1 by a view's model."""
    raw = f"{column}_raw"
    tuned = model.setRawPredictionCol(raw).setProbabilityCol("").setPredictionCol("")
    return tuned.transform(frame).withColumn(column, vector_to_array(raw)[1]).drop(raw)


@dataclass
class CoTrained:
    """Both views' models, their calibration (slope, intercept), the prior log odds and the telling words; no models: no decision."""

    text: LogisticRegressionModel | None = None
    meta: LogisticRegressionModel | None = None
    text_scale: tuple[float, float] = (1.0, 0.0)
    meta_scale: tuple[float, float] = (1.0, 0.0)
    prior: float = 0.0
    words: tuple[str, ...] = ()

    def score(self, docs: DataFrame) -> DataFrame:
        """Add ``text_score``, ``meta_score`` and ``score``, the probabilities of good quality."""
        if self.text is None:
            half = F.lit(0.5)
            return docs.withColumns({"text_score": half, "meta_score": half, "score": half})
        return self.weigh(with_views(docs, self.words))

    def weigh(self, views: DataFrame) -> DataFrame:
        """The scores of documents whose views are there."""
        frame = _odds(self.meta, _odds(self.text, views, "__t"), "__m")
        t = F.col("__t") * self.text_scale[0] + self.text_scale[1]
        m = F.col("__m") * self.meta_scale[0] + self.meta_scale[1]
        p = lambda odds: 1 / (1 + F.exp(-odds))
        return (frame.withColumns({"text_score": p(t), "meta_score": p(m), "score": p(t + m - self.prior)})
                .drop("__text_view", "__meta_view", "__t", "__m"))


def _labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, __y, __part): the labelled documents that the fits use, for fitting (fit) or calibration (hold)."""
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False)) if "toxic" in labels.columns else F.lit(False)
    y = F.when(toxic | (F.col("quality") == 0), 0.0).when(F.col("quality") == 1, 1.0)
    known = (labels.select("doc_id", y.alias("__y")).where("doc_id is not null and __y is not null")
             .groupBy("doc_id").agg(F.min("__y").alias("__y")))
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    chosen = known.join(ids, "doc_id").orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(max_labelled)
    part = F.when(F.pmod(F.xxhash64(F.lit("hold"), "doc_id"), F.lit(4)) == 0, "hold").otherwise("fit")
    return materialise(chosen.withColumn("__part", part).coalesce(1), "labelled")


def telling_words(fit: DataFrame, max_words: int = MAX_WORDS) -> tuple[str, ...]:
    """The words of labelled documents (text, __y) whose presence tells most about the label: the largest chi-square, ties by the word."""
    all_docs, all_bad = fit.agg(F.count("*"), F.sum(1 - F.col("__y"))).first()
    if not all_docs or not 0 < all_bad < all_docs:
        return ()
    seen = bounded_batches(fit).select(F.explode(_terms()).alias("word"), (1 - F.col("__y")).alias("bad"))
    counts = seen.groupBy("word").agg(F.count("*").cast("double").alias("n"), F.sum("bad").alias("bad"))
    total = F.lit(float(all_docs))
    off = F.col("bad") * total - F.col("n") * F.lit(float(all_bad))
    chi = F.try_divide(off * off * total, F.col("n") * (total - F.col("n")) * F.lit(float(all_bad * (all_docs - all_bad))))
    best = counts.where(F.col("n") >= LEAST_DOCS).withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI)
    # at most max_words words of 40 characters come to the driver
    return tuple(r["word"] for r in best.orderBy(F.desc("chi"), "word").limit(max_words).collect())


def _platt(frame: DataFrame, column: str) -> tuple[float, float]:
    one = frame.select(F.col("__y").alias("label"), array_to_vector(F.array(column)).alias("features"))
    m = LogisticRegression(maxIter=50, regParam=1e-4).fit(one)
    return max(0.0, float(m.coefficients[0])), float(m.intercept)


def cotrain(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sure: float = SURE,
            max_labelled: int = MAX_LABELLED, max_words: int = MAX_WORDS) -> CoTrained:
    """Fit both views; ``docs`` without a label, or beyond ``max_labelled``, are the unlabelled pool, however many."""
    return _fit(docs, labels, rounds, sure, max_labelled, max_words)[0]


def _fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sure: float = SURE, max_labelled: int = MAX_LABELLED,
         max_words: int = MAX_WORDS) -> tuple[CoTrained, DataFrame | None]:
    """The fitted views, and (doc_id, both feature vectors) of all documents as a written table; None without a fit."""
    docs = docs.select(*[c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns])
    chosen = _labelled(docs, labels, max_labelled)
    sizes = {(r["__part"], r["__y"]): r["n"] for r in chosen.groupBy("__part", "__y").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(("fit", 0.0)) or not sizes.get(("fit", 1.0)):
        return CoTrained(), None
    # at most max_labelled rows of an id, a label and a word: a proven bound
    small = F.broadcast(chosen)
    words = telling_words(docs.join(small, "doc_id").where("__part = 'fit'"), max_words)
    views = with_views(docs.join(small, "doc_id", "left"), words).select("doc_id", "__text_view", "__meta_view", "__y", F.coalesce("__part", F.lit("pool")).alias("__part"))
    rows = materialise(views, "views")
    labelled, pool = rows.where("__part <> 'pool'").persist(), rows.where("__part = 'pool' and doc_id is not null")
    count = {(r["__part"], r["__y"]): r["n"] for r in labelled.groupBy("__part", "__y").agg(F.count("*").alias("n")).collect()}
    zero, one = count["fit", 0.0], count["fit", 1.0]
    edge = math.log(sure / (1 - sure))
    fit = labelled.where("__part = 'fit'")

    def learn(view: str, extra: DataFrame | None) -> LogisticRegressionModel:
        own = fit.select(F.col(view).alias("features"), F.col("__y").alias("label"), F.lit(1.0).alias("weight"))
        if extra is not None:
            taught = {r["label"]: r["n"] for r in extra.groupBy("label").agg(F.count("*").alias("n")).collect()}
            # pseudo-labels grow with the corpus, the labels do not: together they weigh as much, class by class
            weight = F.when(F.col("label") == 0, min(1.0, zero / taught.get(0.0, zero))).otherwise(min(1.0, one / taught.get(1.0, one)))
            own = own.unionByName(extra.select(F.col(view).alias("features"), "label", weight.alias("weight")))
        m = LogisticRegression(maxIter=25, regParam=1e-3, weightCol="weight").fit(own)
        return m.setFeaturesCol(view)

    def sure_rows(model: LogisticRegressionModel) -> DataFrame:
        """What a view is sure of, for the other view's next fit."""
        return _odds(model, pool, "__o").where(F.abs("__o") >= edge).withColumn("label", (F.col("__o") > 0).cast("double"))

    text, meta = learn("__text_view", None), learn("__meta_view", None)
    for _ in range(rounds - 1):
        text, meta = learn("__text_view", sure_rows(meta)), learn("__meta_view", sure_rows(text))
    out = CoTrained(text, meta, prior=math.log(one / zero), words=words)
    if count.get(("hold", 0.0)) and count.get(("hold", 1.0)):
        held = _odds(meta, _odds(text, labelled.where("__part = 'hold'"), "__t"), "__m").persist()
        out.text_scale, out.meta_scale = _platt(held, "__t"), _platt(held, "__m")
        out.prior = math.log(count["hold", 1.0] / count["hold", 0.0])
        held.unpersist()
    labelled.unpersist()
    return out, rows.select("doc_id", "__text_view", "__meta_view")


def score_all(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, text_score, meta_score, score, keep (score of at least 0.5)."""
    model, views = _fit(docs, labels, **options)
    scored = model.score(docs) if views is None else model.weigh(views)
    return scored.select("doc_id", "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject."""
    names = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))]).columns
    model = cotrain(docs, labels, **options)
    kept = {n: F.col(c) for n, c in zip(names, docs.columns)}
    return (model.score(docs.withColumns(kept)).where("score >= 0.5")
            .select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)]))
