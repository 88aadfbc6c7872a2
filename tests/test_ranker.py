import math

from helpers import rows
from pyspark.sql import functions as F

from cohortsieve.operators import ranker, similar

LONG = "person_id bigint, trial_id string, eligible boolean, biomarker_source string, ajcc_stage string, age_at_dx_years int"


def cohort(spark, n=400):
    """Structured, young patients are approved; a third of all rows are not eligible."""
    long = [(i, t, i % 3 > 0, "nlp" if i % 2 else "structured", "Stage I" if i % 5 else None, 30 + i % 50) for i in range(n) for t in "AB"]
    reviews = [(i, t, "approved" if i % 2 == 0 and i % 50 < 35 else "rejected", 1, j) for j, (i, t, *_) in enumerate(long)]
    reviews += [(1, "A", "approved", 0, -1), (2, "A", "postponed", 2, 10 ** 6), (3, None, "approved", 2, 10 ** 6)]
    seen = spark.createDataFrame([(i,) for i in range(0, n, 2)], "person_id bigint").select("person_id", F.lit("1999-06-01").cast("date").alias("last_seen"))
    return (spark.createDataFrame(long, LONG), seen,
            spark.createDataFrame(reviews, "person_id bigint, trial_id string, decision string, reviewed_at int, review_id bigint"))


def test_learns_what_was_approved(spark):
    long, seen, reviews = cohort(spark)
    train = ranker.training_rows(long, seen, reviews, "2000-01-01")
    assert train.filter("person_id = 2 and trial_id = 'A'").count() == 0 and train.filter("person_id % 3 = 0").count() == 0
    model = ranker.fit_ranker(train)
    assert model.auc > 0.8 and model.coefficients[model.features.index("source")] > 0
    order = ranker.prioritise_learnt(long, seen, "2000-01-01", model)
    got = order.filter("trial_id = 'A'").orderBy("priority").collect()
    eligible = [i for i in range(400) if i % 3]
    assert sorted(r["person_id"] for r in got) == eligible and [r["priority"] for r in got] == list(range(1, len(eligible) + 1))
    assert all((a["score"], -a["person_id"]) >= (b["score"], -b["person_id"]) for a, b in zip(got, got[1:]))
    assert {r["person_id"] % 2 for r in got[:60]} == {0}


def test_score_from_stored_coefficients(spark):
    long, seen, _ = cohort(spark, 60)
    model = ranker.Ranker(("recency", "source", "stage", "age"), (0.5, -1.0, 2.0, 0.25), -0.3, None)
    assert ranker.Ranker.from_json(model.to_json()) == model
    got = {(r["trial_id"], r["person_id"]): r["score"] for r in ranker.prioritise_learnt(long, seen, "2000-01-01", model).collect()}
    features = similar.priority_features("2000-01-01")
    for r in long.filter("eligible").join(seen, "person_id", "left").select("trial_id", "person_id", *(c.alias(n) for n, c in features.items())).collect():
        z = -0.3 + sum(c * r[f] for f, c in zip(model.features, model.coefficients))
        assert abs(got[r["trial_id"], r["person_id"]] - 1 / (1 + math.exp(-z))) < 1e-6


def test_too_little_to_learn_from(spark):
    long, seen, reviews = cohort(spark, 40)
    model = ranker.fit_ranker(ranker.training_rows(long, seen, reviews.filter("decision = 'approved'"), "2000-01-01"))
    assert model.auc is None and set(model.coefficients) == {0.0}
    got = rows(ranker.prioritise_learnt(long, seen, "2000-01-01", model).filter("trial_id = 'B'").select("person_id", "score"), "priority")
    assert [p for p, _ in got] == [i for i in range(40) if i % 3] and {s for _, s in got} == {0.5}
    assert ranker.fit_ranker(ranker.training_rows(long, seen, reviews.limit(0), "2000-01-01")).auc is None
