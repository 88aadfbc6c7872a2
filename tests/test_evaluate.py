from helpers import as_dict, rows
from pyspark.sql import functions as F

from cohortsieve.functions import rules as R
from cohortsieve.operators import evaluate as V

SCHEMA = ("person_id int, config string, note_text string, gold_her2 string, gold_er string, gold_pr string, "
          "pred_her2 string, pred_er string, pred_pr string")
P, N, U = "Positive", "Negative", "Unknown"


def preds(spark, *rows_):
    return spark.createDataFrame([(i, "c", "a note", *r) for i, r in enumerate(rows_)], SCHEMA)


def test_accuracy_counts_missing_answers_as_wrong_and_missing_labels_not_at_all(spark):
    df = preds(spark, (P, P, None, P, N, P), (P, None, None, None, P, P))
    assert rows(V.accuracy(df)) == [(0.5, 0.0, 0.0, 0.1667)]
    assert rows(V.accuracy(df.limit(0))) == [(0.0, 0.0, 0.0, 0.0)]


def test_errors_with_and_without_missing_answers(spark):
    df = preds(spark, (P, P, None, P, N, P), (P, None, None, None, P, P))
    assert rows(V.errors(df).select("person_id", "marker", "predicted", "actual")) == [(0, "ER", N, P)]
    assert V.errors(df, include_null=True).count() == 2


def test_row_scores(spark):
    df = preds(spark, (P, N, None, P, P, P), (None, None, None, None, P, "equivocal"))
    got = V.Scorers().score_rows(df).orderBy("person_id").collect()
    assert [r["her2_exact_match"] for r in got] == [1.0, 1.0]
    assert [r["biomarker_agreement"] for r in got] == [0.5, None]
    assert [r["valid_status_values"] for r in got] == [1.0, 0.0]
    table = V.compare_metrics(V.Scorers().means(df), ["c"])
    assert as_dict(table, "metric", "c") == {"her2_exact_match": 1.0, "biomarker_agreement": 0.5, "valid_status_values": 0.5}


def test_own_scorer(spark):
    scorers = V.Scorers().register("all_unknown", lambda: (F.col("pred_pr") == U).cast("double"))
    got = as_dict(scorers.means(preds(spark, (P, P, P, P, P, U))), "metric", "value")
    assert got["all_unknown"] == 1.0


def test_careful_beats_terse_on_hard_notes(spark):
    notes = spark.createDataFrame([
        (1, 1, "PATHOLOGY_REPORT", "HER2: 2+ (equivocal by IHC). FISH: ratio 2.2, copy number 5.0\nER: 3% weak\nPR: negative"),
        (2, 2, "PATHOLOGY_REPORT", "HER2: Negative (score 1+)\nER: Positive (80%)\nPR: negative"),
        (3, 2, "PROGRESS_NOTE", "zzz"), (4, 4, "PATHOLOGY_REPORT", "no labels"),
    ], "note_id int, person_id int, note_source_value string, note_text string")
    profile = spark.createDataFrame([(1, P, P, N), (2, N, P, N), (4, None, None, None)],
                                    "person_id int, her2_status string, er_status string, pr_status string")
    gold = V.goldset(notes, profile)
    board = V.leaderboard(gold, {"careful": R.CAREFUL, "terse": R.TERSE})
    assert as_dict(board, "config", "overall_acc") == {"careful": 1.0, "terse": 0.6667}
    assert V.best(board).first()["config"] == "careful"
    both = {n: V.predict(gold, {n: r}) for n, r in (("terse", R.TERSE), ("careful", R.CAREFUL))}
    duel = V.head_to_head(both["terse"], both["careful"], "her2", ("terse", "careful"),
                          F.col("note_text").contains("equivocal by IHC"))
    assert rows(duel.select("person_id", "terse_ok", "careful_ok")) == [(1, False, True)]
    assert V.confusion(both["careful"]).filter("actual <> predicted").count() == 0


def test_best_breaks_ties_by_name(spark):
    board = spark.createDataFrame([("b", 0.5), ("a", 0.5)], "config string, overall_acc double")
    assert V.best(board).first()["config"] == "a"


def test_runs_are_appended(spark, tmp_path):
    path = str(tmp_path / "runs")
    for name in ("x", "y"):
        V.record_run(spark.createDataFrame([(name, 1.0)], "run string, overall_acc double"), path, {"rules": name})
    assert rows(spark.read.parquet(path).select("run", "params"), "run") == [("x", '{"rules":"x"}'), ("y", '{"rules":"y"}')]
