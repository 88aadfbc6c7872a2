"""Operator 10, quality rules: base counts per document, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed word unigrams and bigrams: one of trusted documents,
one of the whole corpus. A document's score is the mean log ratio of its n-grams, so that length does
not matter; a document below the fitted threshold is rejected. The method uses built-in functions only.

Scale: one pass counts the corpus (a map-side combine leaves at most ``BUCKETS`` rows per task), one
scores it together with the base counts; the query writes those numbers and reads threshold and verdicts from them. All labels and documents count, for both multinomials and the
threshold. Texts are never shuffled: up to ``SHIPPED`` labelled ids, counted first, are broadcast to them; beyond that, what meets the labels are the n-gram buckets
or scores of documents that a bit map of labelled ids lets through. What reaches the driver is ``BUCKETS`` counts and a histogram of scores in steps of ``STEP``.

Defined cases: a NULL text is an empty one; it has no words, fails the base rules and scores 0.0. Long
texts are read whole. Repeated rows are judged one by one, alike. Without documents there are no
rows; without labels of either quality the threshold is minus infinity, and only base rules reject. Label rows with
NULL are left out; a document with contradicting labels counts as not trusted. ``keep_good`` keeps all columns, whatever their names: rows are held in a struct.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.steps import maybe_of, release, written
from cohortsieve.llm.texts import SPACES, let, table, text_of, words_of

#: Characters that the base rule counts as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14
#: Width of the histogram that the threshold is chosen from.
STEP = 0.0001
#: A fitted threshold may reject at most this share of the trusted documents.
TRUSTED_LOSS = 0.005
SMOOTHING = 1.0
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: The most labelled ids that are broadcast.
SHIPPED = 500_000


@dataclass(frozen=True)
class QualityModel:
    weights: list[float]
    threshold: float


def _buckets(words: Column) -> Column:
    """The bucket of each word and each pair of neighbours."""
    return let(words, _buckets_of)


def _bucket(*words: Column) -> Column:
    # BUCKETS is a power of two: the low bits are the remainder.
    return F.xxhash64(*words).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _single(words: Column) -> Column:
    return F.transform(words, lambda w: _bucket(w))


def _pairs(words: Column) -> Column:
    return F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: _bucket(words[i], w))


def _buckets_of(words: Column) -> Column:
    return F.concat(_single(words), _pairs(words))


def _lowered(text: str = "text") -> Column:
    return words_of(F.lower(text_of(text)))


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, trusted) of all labelled documents."""
    return (labels.filter("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg((F.min("quality") == 1).alias("trusted")))


def fit_weights(docs: DataFrame, known: DataFrame) -> list[float]:
    """The log ratio per bucket, from both multinomials over all of ``docs``; zeros without a trusted document."""
    buckets = _buckets(_lowered())
    total = lambda df, *sums: df.groupBy("bucket").agg(*sums).collect()
    if known.count() <= SHIPPED:
        marked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left")
        counts = total(marked.select(F.explode(buckets).alias("bucket"), F.coalesce("trusted", F.lit(False)).cast("long").alias("t")),
                       F.count("*").alias("raw"), F.sum("t").alias("target"))
    else:
        counts = total(docs.select(F.explode(buckets).alias("bucket")), F.count("*").alias("raw"), F.lit(0).alias("target"))
        trusted = known.filter("trusted").select("doc_id")
        likely = docs.filter(maybe_of("doc_id", trusted)).select("doc_id", buckets.alias("b"))
        counts += total(likely.join(trusted, "doc_id").select(F.explode("b").alias("bucket")), F.lit(0).alias("raw"), F.count("*").alias("target"))
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in counts:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if not any(target):
        return [0.0] * BUCKETS
    all_raw, all_target = sum(raw) + SMOOTHING * BUCKETS, sum(target) + SMOOTHING * BUCKETS
    return [math.log((t + SMOOTHING) / all_target) - math.log((r + SMOOTHING) / all_raw)
            for t, r in zip(target, raw)]


def fit_threshold(scores: DataFrame, known: DataFrame) -> float:
    """The cut from (doc_id, score) of all labelled documents; others are left out."""
    steps = scores.select("doc_id", F.round(F.col("score") / STEP).cast("long").alias("step"))
    found = steps.join(known, "doc_id").groupBy("step").agg(F.sum(F.col("trusted").cast("long")).alias("good"), F.count("*").alias("n")).collect()
    return cut_of([(r["step"] * STEP, r["good"], r["n"] - r["good"]) for r in found])


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Both multinomials over all of ``docs``, and the threshold from all labels; only labelled documents are scored for it."""
    known = written(labelled(labels), "labels")
    weights = fit_weights(docs, known)
    likely = docs.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi") if known.count() <= SHIPPED else docs.filter(maybe_of("doc_id", known))
    model = QualityModel(weights, fit_threshold(likely.select("doc_id", score_of(_lowered(), weights).alias("score")), known))
    release(known)
    return model


def threshold_of(scored: list[tuple[float, bool]]) -> float:
    """``cut_of`` single scores."""
    return cut_of([(score, int(trusted), int(not trusted)) for score, trusted in scored])


def cut_of(groups: list[tuple[float, int, int]]) -> float:
    """The cut that splits (score, trusted, other) counts best (Youden's index), among those that lose few trusted documents."""
    good, bad = sum(g for _, g, _ in groups), sum(b for _, _, b in groups)
    if not good or not bad:
        return -math.inf
    best, cut, lost, caught = 0.0, -math.inf, 0, 0
    ordered = sorted(groups)
    for i, (score, trusted, other) in enumerate(ordered):
        lost, caught = lost + trusted, caught + other
        if lost > TRUSTED_LOSS * good:
            break
        if i + 1 < len(ordered) and ordered[i + 1][0] > score and caught / bad - lost / good > best:
            best, cut = caught / bad - lost / good, (score + ordered[i + 1][0]) / 2
    return cut


def score_of(words: Column, weights: list[float]) -> Column:
    """Mean log ratio over the n-grams of lower-cased ``words``; 0.0 without any."""
    # One literal: Spark folds the cast of the joined text.
    table_ = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = lambda w: F.aggregate(_pairs(w), F.aggregate(w, F.lit(0.0), lambda a, x: a + table_[_bucket(x)]),
                                  lambda a, x: a + table_[x])
    return let(words, lambda w: F.when(F.size(w) > 0, total(w) / (2 * F.size(w) - 1)).otherwise(F.lit(0.0)))


def _repeats(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more.

    Windows are compared by hash first; only those whose hash returns are sorted and compared themselves, so the
    count is exact. ``words`` must be bound (see ``let``).
    """
    n = F.size(words)
    place = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    # 33 bits of a window's hash, then its place: sorted as whole numbers, windows that may be equal are neighbours.
    keys = F.transform(F.slice(words, 3, n - 2), lambda w, i: F.shiftleft(F.xxhash64(words[i], words[i + 1], w), 31).bitwiseOR(i.cast("long")))

    def returning(s: Column) -> Column:
        same = lambda a, b: F.coalesce(F.shiftright(a.bitwiseXOR(F.get(s, b)), 31) == 0, F.lit(False))
        return F.transform(F.filter(s, lambda x, j: same(x, j + 1) | same(x, j - 1)), place)

    def covered(s: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(s, a)["g"] == F.get(s, b)["g"], F.lit(False))
        again = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        return F.size(F.array_distinct(F.flatten(F.transform(
            again, lambda j: F.array(s[j]["i"], s[j]["i"] + 1, s[j]["i"] + 2)))))

    window = lambda i: F.struct(F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("g"), i.alias("i"))
    exact = lambda at: F.when(F.size(at) == 0, 0).otherwise(let(F.sort_array(F.transform(at, window)), covered))
    return F.when(n < 4, 0).otherwise(let(let(F.sort_array(keys), returning), exact))


def _stats(weights: list[float]) -> Column:
    """One struct of the base counts and the score of ``body``."""
    body = F.col("body")
    plain = F.translate(body, SPACES, "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.trim(F.translate(x, SPACES[1:], " " * 5)) != "")
    of_words = let(words_of(body), lambda w: F.struct(
        F.size(w).alias("n"), _repeats(w).alias("repeats"), score_of(F.transform(w, F.lower), weights).alias("score")))
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counts = F.array(F.struct(
        of_words.alias("w"), F.length(plain).alias("chars"),
        (F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))).alias("symbols"), dup_lines.alias("dup")))
    return F.transform(counts, lambda c: F.struct(
        c["w"]["n"].cast("long").alias("n_words"), c["chars"].cast("long").alias("word_chars"),
        c["symbols"].cast("long").alias("n_symbols"), c["dup"].cast("long").alias("n_dup_lines"),
        c["w"]["repeats"].cast("long").alias("n_repeat_words"), c["w"]["score"].alias("score")))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def counted(docs: DataFrame, weights: list[float]) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, score and base_failed."""
    stats = docs.select("doc_id", text_of().alias("body")).select("doc_id", F.inline(_stats(weights)))
    return stats.select("*", base_failed().alias("base_failed"))


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``counted`` with the verdict, kept."""
    return verdicts(counted(docs, model.weights), model.threshold)


def verdicts(counts: DataFrame, threshold: float) -> DataFrame:
    return counts.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns. The decision is made map-side, per row."""
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_of().alias("body"))
    # A generator computes the counts once; a filter is not moved below it.
    held = held.select("row", F.inline(_stats(model.weights)))
    return held.filter(~base_failed() & (F.col("score") >= F.lit(model.threshold))).select("row.*")


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, known = table(spark, folder, "documents"), written(labelled(table(spark, folder, "labels")), "labels")
    counts = written(counted(docs, fit_weights(docs, known)), "quality-counts")
    threshold = fit_threshold(counts, known)
    release(known)
    return verdicts(counts, threshold)
