import datetime as dt

import pytest
from helpers import as_dict, rows
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from cohortsieve.functions import rules as R
from cohortsieve.operators import report, review
from cohortsieve.sources import schemas, sinks
from cohortsieve.sources.tables import Source, criteria
from cohortsieve.streaming import incremental

REVIEW = "review_id bigint, person_id bigint, trial_id string, decision string, reasoning string, reviewed_at timestamp"
LONG = "person_id bigint, trial_id string, eligible boolean"


def at(hour):
    return dt.datetime(2024, 1, 1, hour)


def test_conform_adds_casts_orders_and_drops(spark):
    df = spark.createDataFrame([("x", 1, "7")], "extra string, person_id int, measurement_id string")
    got = schemas.conform(df, schemas.omop("measurement"))
    assert got.columns == schemas.omop("measurement").names and len(got.columns) == 23
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in schemas.omop("measurement").fields]
    assert got.first()["measurement_id"] == 7 and got.first()["value_source_value"] is None


def test_conform_keeps_not_null(spark):
    layout = StructType.fromDDL("a bigint not null, b string not null, c int")
    df = spark.createDataFrame([("1", "x"), (None, "y"), ("2", None)], "a string, b string")
    assert rows(schemas.conform_checked(df, layout, "drop")) == [(1, "x", None)]
    assert [r["null_columns"] for r in schemas.conform_checked(df, layout, "warn").collect()] == [[], ["a"], ["b"]]
    with pytest.raises(Exception, match="NULL in NOT NULL column: a"):
        schemas.conform_checked(df.filter("b = 'y'"), layout).collect()
    assert rows(schemas.conform_checked(df.filter("a = '1'"), layout)) == [(1, "x", None)]
    assert list(schemas.required(layout)) == ["a is set", "b is set"]


def test_criteria_is_read_without_a_job(spark):
    df = criteria(spark)
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()
    assert [r["trial_id"] for r in df.collect()] == ["A", "B", "C"]


def test_source_by_path_and_by_database(spark, tmp_path):
    spark.createDataFrame([(1,)], "person_id bigint").write.parquet(str(tmp_path / "person"))
    by_path = Source(spark, path=str(tmp_path))
    by_path.register_views(["person"])
    assert rows(spark.table("person")) == [(1,)]
    assert by_path.conformed("person").columns[-1] == "is_high_profile"
    with pytest.raises(ValueError):
        Source(spark)


def test_rewrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    sinks.write_table(spark.range(1).withColumn("b", F.lit("x")), path)
    assert rows(spark.read.parquet(path)) == [(0, "x")]


def test_comments_travel(spark):
    df = sinks.describe_columns(spark.range(1), {"id": "One patient."})
    assert df.schema["id"].metadata == {"comment": "One patient."}
    with pytest.raises(ValueError):
        sinks.describe_columns(spark.range(1), {"no": "x"})


def test_refresh_builds_inputs_once_and_first(spark):
    built = []

    def make(name):
        return lambda *frames: built.append(name) or spark.range(len(frames) + 1)

    builders = {"a": ((), make("a")), "b": (("a",), make("b")), "c": (("a", "b"), make("c"))}
    assert sinks.refresh("c", builders, lambda n, df: df).count() == 3
    assert built == ["a", "b", "c"]
    with pytest.raises(ValueError, match="circular"):
        sinks.refresh("x", {"x": (("y",), make("x")), "y": (("x",), make("y"))}, lambda n, df: df)


def test_reviews_latest_wins_and_ties_go_to_the_larger_id(spark):
    log = spark.createDataFrame([(1, 7, "A", "approved", "", at(1)), (2, 7, "A", "rejected", "", at(1)),
                                 (3, 7, "B", "approved", "", at(2))], REVIEW)
    new = spark.createDataFrame([(4, 7, "B", "rejected", "", at(1)), (5, 8, "A", "approved", "", at(3))], REVIEW)
    got = review.record_reviews(review.record_reviews(None, log), new)
    assert rows(got.select("person_id", "trial_id", "review_id"), "person_id", "trial_id") == [(7, "A", 2), (7, "B", 3), (8, "A", 5)]
    long = spark.createDataFrame([(7, "A", True), (7, "B", False), (9, "A", True)], LONG)
    eff = review.effective(long, log.unionByName(new))
    assert rows(eff.select("person_id", "trial_id", "effective_eligible"), "person_id", "trial_id") == [
        (7, "A", False), (7, "B", True), (9, "A", True)]
    assert rows(review.review_summary(long, log), "trial_id") == [("A", 1, 1, 0, 1, 0), ("B", 0, 0, 1, 0, 0)]


def test_timeline_falls_back(spark):
    m = spark.createDataFrame([(1, None, at(5), "Ki-67", None, 12.5, "%"), (None, None, at(5), "x", "y", None, None)],
                              "person_id bigint, measurement_date date, measurement_datetime timestamp, "
                              "measurement_source_value string, value_source_value string, value_as_number double, unit_source_value string")
    assert rows(report.timeline(m)) == [(1, dt.date(2024, 1, 1), "Ki-67", "12.5", "%")]


def test_baseline_from_raw_facts(spark):
    m = spark.createDataFrame([(1, "HER2/neu", "Positive"), (2, "HER2/neu", "Positive"), (3, "HER2/neu", "Negative"),
                               (3, "Estrogen receptor", "Positive"), (4, "HER2/neu", "Positive")],
                              "person_id bigint, measurement_source_value string, value_source_value string")
    c = spark.createDataFrame([(i, "Malignant neoplasm of breast") for i in (1, 1, 2, 3)],
                              "person_id bigint, condition_source_value string")
    o = spark.createDataFrame([(3, "Menopausal status", "Postmenopausal")],
                              "person_id bigint, observation_source_value string, value_source_value string")
    d = spark.createDataFrame([(2, "Trastuzumab"), (1, "Paclitaxel")], "person_id bigint, drug_source_value string")
    assert rows(report.baseline_counts(m, c, o, d), "trial_id") == [("A", 1), ("B", 1)]
    unknown_person = d.unionByName(spark.createDataFrame([(None, "Pertuzumab")], d.schema))
    assert rows(report.baseline_counts(m, c, o, unknown_person), "trial_id") == [("A", 0), ("B", 1)]


NOTE = "note_id bigint, person_id bigint, note_source_value string, note_text string"


def add_notes(spark, folder, *notes):
    spark.createDataFrame([(i, i, "PATHOLOGY_REPORT", t) for i, t in notes], NOTE).coalesce(1).write.mode("append").parquet(folder)


def test_only_new_notes_are_read_and_a_refresh_starts_over(spark, tmp_path):
    folder, equivocal = str(tmp_path / "notes"), "HER2: 2+ (equivocal by IHC). FISH: ratio 2.2, copy number 4.4"
    table = incremental.ExtractionTable(spark, str(tmp_path / "table"))

    def notes():
        return spark.readStream.schema(NOTE).parquet(folder)

    add_notes(spark, folder, (1, equivocal))
    assert table.update(notes(), R.TERSE) == 0
    assert as_dict(table.read(), "note_id", "her2_status") == {1: "Unknown"}
    add_notes(spark, folder, (2, "HER2: 3+"))
    with pytest.raises(ValueError, match="terse"):
        table.update(notes(), R.CAREFUL)
    assert table.update(notes(), R.TERSE) == 0 and table.read().count() == 2
    assert table.update(notes(), R.TERSE) == 0 and table.read().count() == 2
    assert table.full_refresh(notes(), R.CAREFUL) == 1
    assert as_dict(table.read(), "note_id", "her2_status") == {1: "Positive", 2: "Positive"}


def test_a_refresh_that_died_leaves_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "notes")
    table = incremental.ExtractionTable(spark, str(tmp_path / "table"))
    add_notes(spark, folder, (1, "HER2: 2+ (equivocal by IHC). FISH: ratio 2.2, copy number 4.4"))
    notes = lambda: spark.readStream.schema(NOTE).parquet(folder)
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **k: 1 / 0)  # dies before the ledger row
        with pytest.raises(ZeroDivisionError):
            table.full_refresh(notes(), R.TERSE)
    assert table.generation() == -1
    assert table.full_refresh(notes(), R.CAREFUL) == 0
    assert as_dict(table.read(), "note_id", "her2_status") == {1: "Positive"}


def test_undecided_reviews_and_reviews_without_a_trial(spark):
    long = spark.createDataFrame([(1, "A", True), (2, "A", False), (3, "A", True)], "person_id bigint, trial_id string, eligible boolean")
    log = spark.createDataFrame([(1, 1, "A", "pending", "", at(1)), (2, 2, None, "approved", "", at(1)), (3, 3, "A", "rejected", "", at(1))], REVIEW)
    got = review.effective(long, log)
    assert as_dict(got, "person_id", "effective_eligible") == {1: True, 2: False, 3: False}


def test_review_stream_keeps_the_latest_over_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for row in [(1, 7, "A", "approved", "", at(2)), (2, 7, "A", "rejected", "", at(1))]:
        spark.createDataFrame([row], REVIEW).write.mode("append").parquet(folder)
        incremental.stream_reviews(spark.readStream.schema(REVIEW).parquet(folder), out, str(tmp_path / "state"))
    assert rows(incremental.read_reviews(spark, out).select("review_id", "decision")) == [(1, "approved")]


def test_refresh_rebuilds_what_is_stale(spark, tmp_path):
    facts, notes, root = (str(tmp_path / n) for n in ("facts", "notes", "out"))
    for p in (facts, notes):
        spark.range(3).write.parquet(p)
    fail = []

    def unified(a, b):
        if fail:
            raise RuntimeError("while building")
        return a.union(b)

    def builders(version=""):
        return {"profile": sinks.Builder(lambda: spark.read.parquet(facts), files=(facts,)),
                "extracted": sinks.Builder(lambda: spark.read.parquet(notes), files=(notes,), version=version),
                "unified": sinks.Builder(unified, inputs=("profile", "extracted")),
                "counts": sinks.Builder(lambda u: u.groupBy("id").count(), inputs=("unified",))}

    def refresh(version=""):
        frame, rebuilt = sinks.refresh_stale(spark, "counts", builders(version), root)
        return sorted(r["count"] for r in frame.collect()), rebuilt

    assert refresh() == ([2, 2, 2], ["profile", "extracted", "unified", "counts"]) and refresh() == ([2, 2, 2], [])
    spark.range(1).write.mode("append").parquet(notes)
    assert refresh() == ([2, 2, 3], ["extracted", "unified", "counts"])
    fail.append(1)
    with pytest.raises(RuntimeError):
        refresh("2")
    fail.clear()
    assert refresh("2") == ([2, 2, 3], ["unified", "counts"]) and refresh("2") == ([2, 2, 3], [])
    with pytest.raises(ValueError, match="circular"):
        sinks.refresh_stale(spark, "a", {"a": sinks.Builder(lambda x: x, inputs=("a",))}, root)
