"""Measuring an extractor against labelled rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cohortsieve import vocabulary as v
from cohortsieve.functions.rules import RuleSet
from cohortsieve.operators.extract import extract_each, extract_side_by_side

# Short label name -> status column of a prediction.
LABELS = {"her2": "her2_status", "er": "er_status", "pr": "pr_status"}


def goldset(notes: DataFrame, profile: DataFrame) -> DataFrame:
    """Persons with a pathology report and at least one structured label.

    Several reports of one person reduce to the largest text.
    """
    texts = notes.filter(F.col("note_source_value") == v.PATHOLOGY_REPORT) \
        .groupBy("person_id").agg(F.max("note_text").alias("note_text"))
    gold = profile.select("person_id", *(F.col(c).alias(f"gold_{k}") for k, c in LABELS.items()))
    labelled = F.coalesce(*(F.col(f"gold_{k}") for k in LABELS)).isNotNull()
    return texts.join(gold.filter(labelled), "person_id")


def predict(gold: DataFrame, configs: dict[str, RuleSet]) -> DataFrame:
    """Predictions of every configuration from one pass over the texts."""
    answered = extract_each(gold, "note_text", configs)
    return answered.withColumnsRenamed({c: f"pred_{k}" for k, c in LABELS.items()})


def _accuracy(label: str) -> Column:
    gold, pred = F.col(f"gold_{label}"), F.col(f"pred_{label}")
    right = F.count(F.when(gold == pred, 1))
    return F.coalesce(F.try_divide(right.cast("double"), F.count(gold)), F.lit(0.0))


def accuracy(preds: DataFrame, labels: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Share of labelled rows predicted right, per label and on average; nothing labelled gives 0."""
    labels = labels or list(LABELS)
    scored = preds.groupBy(*(by or [])).agg(*(_accuracy(k).alias(f"_{k}") for k in labels))
    mean = sum((F.col(f"_{k}") for k in labels[1:]), F.col(f"_{labels[0]}")) / float(len(labels))
    return scored.select(*(by or []), *(F.round(f"_{k}", 4).alias(f"{k}_acc") for k in labels),
                         F.round(mean, 4).alias("overall_acc"))


def leaderboard(gold: DataFrame, configs: dict[str, RuleSet]) -> DataFrame:
    return accuracy(predict(gold, configs), by=["config"])


def best(board: DataFrame, score: str = "overall_acc") -> DataFrame:
    """The configuration with the highest score, ties by name."""
    return board.orderBy(F.desc(score), "config").limit(1)


def labelled_pairs(preds: DataFrame, carry: list[str], labels: dict[str, str] | None = None) -> DataFrame:
    """One row per label with its actual and predicted value."""
    names = labels or {k: k.upper() for k in LABELS}
    cells = F.array(*(
        F.struct(F.lit(shown).alias("marker"), F.col(f"gold_{k}").alias("actual"),
                 F.col(f"pred_{k}").alias("predicted"))
        for k, shown in names.items()
    ))
    return preds.select(*carry, F.inline(cells))


def errors(preds: DataFrame, *, snippet_chars: int = 220, include_null: bool = False,
           carry: list[str] | None = None) -> DataFrame:
    """Labels predicted wrong, with the start of the note for the reader (scoring uses all of it)."""
    shown = preds.withColumn("note_snippet", F.substring("note_text", 1, snippet_chars))
    pairs = labelled_pairs(shown, [*(carry or ["person_id"]), "note_snippet"])
    differs = F.col("actual") != F.col("predicted")
    if include_null:
        differs = F.coalesce(differs, F.lit(True))
    return pairs.filter(F.col("actual").isNotNull() & differs)


def head_to_head(a: DataFrame, b: DataFrame, label: str, names: tuple[str, str],
                 predicate: Column | None = None, snippet_chars: int = 180) -> DataFrame:
    """Two predictions for the same persons next to the gold label."""
    first, second = names
    gold = F.col(f"gold_{label}")
    left = a.select("person_id", "note_text", gold, F.col(f"pred_{label}").alias(f"{first}_{label}"))
    right = b.select("person_id", F.col(f"pred_{label}").alias(f"{second}_{label}"))
    if predicate is not None:
        left = left.filter(predicate)
    return left.join(right, "person_id").select(
        "person_id", gold,
        f"{first}_{label}", (F.col(f"{first}_{label}") == gold).alias(f"{first}_ok"),
        f"{second}_{label}", (F.col(f"{second}_{label}") == gold).alias(f"{second}_ok"),
        F.substring("note_text", 1, snippet_chars).alias("note_snippet"),
    )


def rules_head_to_head(gold: DataFrame, configs: dict[str, RuleSet], label: str, predicate: Column | None = None, snippet_chars: int = 180) -> DataFrame:
    """``head_to_head`` of two rule sets, from one pass over the texts and without a join."""
    rows = gold if predicate is None else gold.filter(predicate)
    read, truth = extract_side_by_side(rows, "note_text", configs), F.col(f"gold_{label}")
    answers = [c for name in configs for c in (F.col(f"{name}_{LABELS[label]}").alias(f"{name}_{label}"),
                                               (F.col(f"{name}_{LABELS[label]}") == truth).alias(f"{name}_ok"))]
    return read.select("person_id", truth, *answers, F.substring("note_text", 1, snippet_chars).alias("note_snippet"))


# Row scorers -------------------------------------------------------------------------------------

def exact_match(label: str) -> Column:
    """1 where prediction and gold are the same, two missing values included."""
    return F.col(f"gold_{label}").eqNullSafe(F.col(f"pred_{label}")).cast("double")


def marker_agreement() -> Column:
    """Share of a row's labelled markers that were predicted right; NULL without any label."""
    graded = sum((F.col(f"gold_{k}").isNotNull().cast("int") for k in LABELS), F.lit(0))
    right = sum((F.coalesce((F.col(f"gold_{k}") == F.col(f"pred_{k}")).cast("int"), F.lit(0)) for k in LABELS), F.lit(0))
    return F.try_divide(right.cast("double"), graded)


def valid_values(allowed: list[str] = v.STATUSES) -> Column:
    """1 where every prediction is an allowed value."""
    ok = [F.coalesce(F.col(f"pred_{k}").isin(allowed), F.lit(False)) for k in LABELS]
    return (ok[0] & ok[1] & ok[2]).cast("double")


class Scorers:
    """Named row scorers; users add their own Column expressions."""

    def __init__(self) -> None:
        self._scorers: dict[str, Callable[[], Column]] = {
            "her2_exact_match": lambda: exact_match("her2"),
            "biomarker_agreement": marker_agreement,
            "valid_status_values": valid_values,
        }

    def register(self, name: str, scorer: Callable[[], Column]) -> Scorers:
        self._scorers[name] = scorer
        return self

    def score_rows(self, preds: DataFrame) -> DataFrame:
        return preds.withColumns({n: s() for n, s in self._scorers.items()})

    def means(self, preds: DataFrame, by: str = "config") -> DataFrame:
        """(by, metric, value) with each scorer's mean; rows a scorer cannot grade do not count."""
        averaged = self.score_rows(preds).groupBy(by).agg(*(F.avg(n).alias(n) for n in self._scorers))
        cells = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in self._scorers))
        return averaged.select(by, F.inline(cells))


def compare_metrics(means: DataFrame, configs: list[str], by: str = "config") -> DataFrame:
    """One row per metric, one column per configuration."""
    return means.groupBy("metric").agg(
        *(F.round(F.max(F.when(F.col(by) == c, F.col("value"))), 4).alias(c) for c in configs))


def with_case_type(df: DataFrame, hard: Column) -> DataFrame:
    return df.withColumn("case_type", F.when(hard, "hard").otherwise("clear"))


def record_run(df: DataFrame, path: str, params: dict[str, str]) -> None:
    """Append a run's metrics, with what it was run with, to a table of runs."""
    df.withColumn("params", F.to_json(F.struct(*(F.lit(val).alias(k) for k, val in sorted(params.items()))))) \
        .write.mode("append").parquet(path)


def confusion(preds: DataFrame, by: list[str] | None = None, labels: dict[str, str] | None = None) -> DataFrame:
    by = by or []
    return labelled_pairs(preds, by, labels).groupBy(*by, "marker", "actual", "predicted") \
        .agg(F.count(F.lit(1)).alias("n"))
