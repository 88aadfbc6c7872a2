"""A contact order learnt from past decisions. It orders patients that the rules already passed and never decides who is eligible."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from cohortsieve.operators.ranking import rank_within
from cohortsieve.operators.review import KEYS, latest_by, newest_first
from cohortsieve.operators.similar import priority_features
from cohortsieve.session import cut_lineage

REGULARISATION = (0.001, 0.01, 0.1)


@dataclass(frozen=True)
class Ranker:
    """A fitted logistic regression; ``auc`` is the mean over held-out folds, None if it could not be measured."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    auc: float | None

    def score(self, features: dict[str, Column]) -> Column:
        """The chance of approval, as a Column expression."""
        total = sum((F.lit(c) * features[f] for f, c in zip(self.features, self.coefficients)), F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Ranker:
        d = json.loads(text)
        return Ranker(tuple(d["features"]), tuple(d["coefficients"]), d["intercept"], d["auc"])


def _eligible(long: DataFrame, last_seen: DataFrame) -> DataFrame:
    return long.filter("eligible").join(last_seen, "person_id", "left")


def training_rows(long: DataFrame, last_seen: DataFrame, reviews: DataFrame, as_of: str) -> DataFrame:
    """(person_id, trial_id, label, features): eligible rows with a latest decision; approved is 1, rejected 0, other words are left out."""
    decided = latest_by(reviews.filter(F.col("trial_id").isNotNull()), KEYS, newest_first()).filter(F.col("decision").isin("approved", "rejected"))
    features = priority_features(as_of)
    return _eligible(long, last_seen).join(decided.select(*KEYS, (F.col("decision") == "approved").cast("double").alias("label")), KEYS) \
        .select(*KEYS, "label", *(c.alias(n) for n, c in features.items()))


def fit_ranker(rows: DataFrame, folds: int = 4) -> Ranker:
    """The regression whose strength of regularisation does best on held-out persons, fitted on all rows.

    Folds are cut by person, so no person is on both sides. With one label only, or too few rows for the folds, every patient scores alike.
    """
    names = tuple(c for c in rows.columns if c not in (*KEYS, "label"))
    rows = cut_lineage(rows.withColumn("fold", F.pmod(F.xxhash64("person_id"), F.lit(folds)).cast("int")), "training")
    sides = rows.groupBy("fold").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).collect()
    if len(sides) < folds or any(s["lo"] == s["hi"] for s in sides):
        return Ranker(names, (0.0,) * len(names), 0.0, None)
    table = VectorAssembler(inputCols=list(names), outputCol="x").transform(rows)
    model = LogisticRegression(featuresCol="x", labelCol="label", maxIter=50)
    search = CrossValidator(
        estimator=model, estimatorParamMaps=ParamGridBuilder().addGrid(model.regParam, list(REGULARISATION)).build(),
        evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC"), numFolds=folds, foldCol="fold")
    found = search.fit(table)
    best = found.bestModel
    return Ranker(names, tuple(float(c) for c in best.coefficients), float(best.intercept), float(max(found.avgMetrics)))


def prioritise_learnt(long: DataFrame, last_seen: DataFrame, as_of: str, model: Ranker) -> DataFrame:
    """Contact order of eligible patients per trial by the learnt score; ties by person."""
    scored = _eligible(long, last_seen).select("trial_id", "person_id", F.round(model.score(priority_features(as_of)), 6).alias("score"))
    return rank_within(cut_lineage(scored, "scores"), ["trial_id"], [F.desc("score"), F.asc("person_id")], "priority")
