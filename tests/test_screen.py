from helpers import PATIENT, as_dict, patient, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cohortsieve import vocabulary as v
from cohortsieve.operators import report, screen
from cohortsieve.sources.tables import criteria

OPEN = ("O", "Open", "Recruiting", None, 18, 75, None, None, None, None, None, None, "Anyone in the age range.")


def screened(spark, patients, trials=tuple(v.TRIALS), **kw):
    return screen.screen(spark.createDataFrame(patients, PATIENT), criteria(spark, trials), **kw)


def reasons(df, trial="A"):
    return as_dict(df.filter(F.col("trial_id") == trial), "person_id", "reason")


def test_reasons_name_the_first_failure_in_order(spark):
    got = reasons(screened(spark, [
        patient(1), patient(2, her2="Negative", age=90), patient(3, her2=None), patient(4, age=80, prior=True),
        patient(5, prior=True, gender="MALE"), patient(6, gender="MALE"), patient(7, gender="Female", source="nlp"),
        patient(8, age=None), patient(9, gender=None),
    ]))
    assert got == {
        1: "Eligible: HER2 Positive, age 50 (structured)",
        2: "Excluded: HER2 is Negative (need Positive)",
        3: "Excluded: HER2 is Unknown (need Positive)",
        4: "Excluded: age 80 outside 18 to 75",
        5: "Excluded: prior anti-HER2 therapy",
        6: "Excluded: sex MALE (need Female)",
        7: "Eligible: HER2 Positive, age 50 (nlp)",
        8: None,
        9: None,
    }


def test_other_trials(spark):
    df = screened(spark, [patient(1, her2="Negative"), patient(2, her2="Negative", meno=None),
                          patient(3, her2="Negative", er="Negative", pr="Negative"),
                          patient(4, her2="Negative", er="Negative", pr=None)])
    assert reasons(df, "B")[1] == "Eligible: HER2 Negative, ER Positive, Postmenopausal, age 50 (structured)"
    assert reasons(df, "B")[2] == "Excluded: menopausal status unknown (need Postmenopausal)"
    assert reasons(df, "C")[3] == "Eligible: HER2 Negative, ER Negative, PR Negative, age 50 (structured)"
    assert reasons(df, "C")[4] == "Excluded: PR is Unknown (need Negative)"


def test_flags_stay_three_valued(spark):
    got = screened(spark, [patient(1, her2=None, age=None)], flags=True).filter("trial_id = 'A'").first()
    assert got["ok_her2"] is None and got["ok_age"] is None and got["ok_er"] is True
    assert got["eligible"] is False and got["first_failure"] == "her2"


def test_stored_false_requirement_never_passes(spark):
    never = (*OPEN[:10], False, *OPEN[11:])
    df = screened(spark, [patient(1), patient(2, prior=True)], [never])
    assert as_dict(df, "person_id", "eligible") == {1: False, 2: False}


def test_no_trials_gives_no_rows(spark):
    none = criteria(spark).filter("trial_id = 'Z'")
    assert screen.screen(spark.createDataFrame([patient(1)], PATIENT), none).count() == 0


def test_stage_list_as_one_more_row(spark):
    late = (*OPEN, ["Stage IIIA", "Stage IV"])
    trials = criteria(spark, [late, (*v.TRIALS[0], None)], v.TRIAL_COLUMNS + ", req_stage array<string>")
    people = spark.createDataFrame([patient(1), patient(2, stage="Stage IV"), patient(3, stage=None)], PATIENT)
    got = reasons(screen.screen(people, trials), "O")
    assert got == {1: "Excluded: Stage I (need Stage IIIA or Stage IV)",
                   2: "Eligible: Stage IV, age 50 (structured)",
                   3: "Excluded: stage unknown (need Stage IIIA or Stage IV)"}


def test_many_trials_take_the_grid_and_say_the_same(spark):
    many = [(f"T{i:03d}", *v.TRIALS[i % 3][1:]) for i in range(screen.TRIALS_IN_PLAN * 2 + 5)]
    people = [patient(i, her2=["Positive", "Negative", None][i % 3], age=15 + i) for i in range(40)]
    df = screened(spark, people, many)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Cross" not in plan
    by_few = {(r["person_id"], r["trial_id"]): r["reason"] for r in screened(spark, people).collect()}
    got = {(r["person_id"], r["trial_id"]): r["reason"] for r in df.collect()}
    assert len(got) == len(people) * len(many)
    assert all(reason == by_few[p, "ABC"[int(t[1:]) % 3]] for (p, t), reason in got.items())


def test_few_trials_need_no_join(spark):
    plan = screened(spark, [patient(1)])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "from_json" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 100), st.sampled_from(["Positive", "Negative", None]), st.booleans()),
                min_size=1, max_size=8))
def test_an_open_trial_takes_everyone_in_range(spark, people):
    df = screened(spark, [patient(i, age=a, her2=h, prior=p, gender=None) for i, (a, h, p) in enumerate(people)], [OPEN])
    got = as_dict(df, "person_id", "eligible")
    assert got == {i: 18 <= a <= 75 for i, (a, _, _) in enumerate(people)}


def test_widen_and_summaries_agree_with_the_long_form(spark):
    people = [patient(i, her2=["Positive", "Negative"][i % 2], source=["structured", "nlp"][i // 3 % 2]) for i in range(12)]
    long = screened(spark, people)
    wide = screen.widen(long, "person_id", "trial_id", ["A", "B", "C"], ["eligible", "reason"], ["gender"])
    back = {(r["person_id"], t): r[f"trial_{t.lower()}_reason"] for r in wide.collect() for t in "ABC"}
    assert back == {(r["person_id"], r["trial_id"]): r["reason"] for r in long.collect()}
    assert rows(report.uplift(long), "trial_id") == [("A", 4, 6, 2, 50.0), ("B", 2, 6, 4, 200.0), ("C", 0, 0, 0, None)]
    total = report.eligibility_summary(long, ["trial_id", "biomarker_source"]).groupBy("trial_id").sum("eligible_patients")
    assert rows(total, "trial_id") == [r[:2] for r in rows(report.eligibility_summary(long), "trial_id")]


def test_subset_screens_only_what_was_asked(spark):
    people = spark.createDataFrame([patient(1), patient(2)], PATIENT)
    got = screen.screen_subset(people, criteria(spark), people.filter("person_id = 2"), ["B"])
    assert rows(got.select("person_id", "trial_id")) == [(2, "B")]


def test_missing_therapy_means_none(spark):
    demo = spark.createDataFrame([(1, "F", 50, None, None, None)],
                                 "person_id bigint, gender_source_value string, age_at_dx_years int, dx_date date, "
                                 "menopausal_status string, ajcc_stage string")
    profile = spark.createDataFrame([(1, "Positive", None, None, "nlp"), (2, None, None, None, "nlp")],
                                    "person_id bigint, her2_status string, er_status string, pr_status string, biomarker_source string")
    therapy = spark.createDataFrame([], "person_id bigint, had_anti_her2_therapy boolean, had_endocrine_therapy boolean")
    got = screen.patient_frame(profile, demo, therapy).collect()
    assert [(r["person_id"], r["prior_anti_her2"]) for r in got] == [(1, False)]


def test_trial_values_do_not_depend_on_their_number(spark):
    import datetime as dt

    at = dt.datetime(2026, 1, 1, 0, 0, 0, 123456)
    people = spark.createDataFrame([(1,)], "person_id bigint")
    for n in (3, screen.TRIALS_IN_PLAN + 6):
        trials = spark.createDataFrame([(f"T{i}", "on", at, [1.5, None], None) for i in range(n)],
                                       "trial_id string, status string, opened timestamp, doses array<double>, note string")
        got = screen.with_trials(people, trials).select("opened", "doses", "note").distinct().collect()
        assert [tuple(r) for r in got] == [(at, [1.5, None], None)]
