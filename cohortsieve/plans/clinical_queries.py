"""Coverage, extraction, fusion, screening, evaluation, similarity, review and streaming."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F

from cohortsieve import vocabulary as v
from cohortsieve.functions import rules as R
from cohortsieve.functions.statuses import normalise_status, parse_response
from cohortsieve.functions.vectors import cosine
from cohortsieve.operators import coverage as G
from cohortsieve.operators import evaluate as V
from cohortsieve.operators import extract as X
from cohortsieve.operators import fuse, ranker, report, review, screen, similar
from cohortsieve.operators.profiling import first_rows
from cohortsieve.plans.registry import Data, query, text
from cohortsieve.session import cut_lineage, new_folder
from cohortsieve.sources.tables import criteria
from cohortsieve.streaming import incremental

BOTH_RULES = {"careful": R.CAREFUL, "terse": R.TERSE}
STATUS_COLUMNS = list(v.MARKERS)


# Coverage, extraction, fusion --------------------------------------------------------------------

@query("g1_coverage", "SELECT person_id, evidence FROM evidence", "evidence")
def _(d: Data):
    return G.coverage(d.table("person"), d.profile, d.reports, "person_id")


@query("g1_coverage_counts", "SELECT evidence, count(*) AS patients FROM evidence GROUP BY evidence", "evidence")
def _(d: Data):
    return G.coverage(d.table("person"), d.profile, d.reports, "person_id") \
        .groupBy("evidence").agg(F.count(F.lit(1)).alias("patients"))


@query("g2_only_in_notes", """
SELECT DISTINCT person_id FROM note WHERE note_source_value = 'PATHOLOGY_REPORT'
  AND NOT EXISTS (SELECT 1 FROM profile s WHERE s.person_id = note.person_id)""", "note", "profile")
def _(d: Data):
    return G.only_in(d.reports, d.profile, "person_id")


@query("g2_gap_share", """
SELECT count(*) FILTER (WHERE evidence = 'notes-only') AS gap, count(*) AS total,
  round(100.0 * count(*) FILTER (WHERE evidence = 'notes-only') / count(*), 0) AS gap_pct FROM evidence""",
       "evidence")
def _(d: Data):
    return G.gap_share(G.coverage(d.table("person"), d.profile, d.reports, "person_id"), "notes-only")


@query("g2_sample_notes", """
SELECT person_id, note_id, note_text FROM note WHERE note_source_value = 'PATHOLOGY_REPORT'
  AND person_id NOT IN (SELECT person_id FROM profile) ORDER BY person_id, note_id LIMIT 3""", "note", "profile")
def _(d: Data):
    gap = G.only_in(d.reports, d.profile, "person_id")
    return first_rows(d.reports.select("person_id", "note_id", "note_text"), gap, "person_id", ["person_id", "note_id"], 3)


@query("g3_extract", """
SELECT note_id, her2_status, er_status, pr_status FROM read_careful""", "read_careful")
def _(d: Data):
    return X.extract(d.table("note"), "note_text").select("note_id", *STATUS_COLUMNS)


@query("g4_careful_rules", """
SELECT her2_status, er_status, pr_status, count(*) AS notes FROM read_careful GROUP BY ALL""", "read_careful")
def _(d: Data):
    return X.extract(d.table("note"), "note_text", R.CAREFUL).groupBy(*STATUS_COLUMNS) \
        .agg(F.count(F.lit(1)).alias("notes"))


@query("g5_terse_rules", """
SELECT note_id, her2_status, er_status, pr_status FROM read_terse""", "read_terse")
def _(d: Data):
    return X.extract(d.table("note"), "note_text", R.TERSE).select("note_id", *STATUS_COLUMNS)


@query("g6_parse_response", """
SELECT event_id, CAST(props::JSON->>'k' AS INT) AS k,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(props::JSON->>'k' AS INT) END AS parsed FROM events""")
def _(d: Data):
    """Answers in every shape a model gives: flat, wrapped, fenced and broken."""
    props = F.col("props")
    answer = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("sorry, "), F.substring_index(props, ":", 1)))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"result": '), props, F.lit("}")))
        .when(F.col("event_type") == "click", F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .otherwise(props)
    )
    return d.raw("events").select(
        "event_id", parse_response(props, "k int").getField("k").alias("k"),
        parse_response(answer, "k int").getField("k").alias("parsed"))


@query("g7_normalise_status", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'Unknown' END AS status FROM events""")
def _(d: Data):
    return d.raw("events").select(
        "event_id", normalise_status(F.col("event_type"), ["click", "view"]).alias("status"))


@query("g8_one_per_entity", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def _(d: Data):
    return X.one_per_entity(d.raw("events"), "user_id", "event_id").select("user_id", "event_id", "event_type")


@query("g9_recovery", """
SELECT count(*) AS gap_entities, count(x.person_id) AS recovered,
  count(*) FILTER (WHERE x.her2_status <> 'Unknown') AS with_definite_status
FROM (SELECT DISTINCT person_id FROM note WHERE note_source_value = 'PATHOLOGY_REPORT'
        AND person_id NOT IN (SELECT person_id FROM profile)) g
LEFT JOIN extracted x ON x.person_id = g.person_id""", "note", "profile", "extracted")
def _(d: Data):
    return X.recovery(G.only_in(d.reports, d.profile, "person_id"), d.extracted, "person_id", "her2_status")


@query("g10_agreement", """
SELECT count(*) AS n, count(*) FILTER (WHERE s.her2_status = x.her2_status) AS agree,
  round(100.0 * count(*) FILTER (WHERE s.her2_status = x.her2_status) / count(*), 1) AS agree_pct
FROM (SELECT person_id, max(value_source_value) AS her2_status FROM measurement
      WHERE measurement_source_value = 'HER2/neu' GROUP BY person_id) s
JOIN extracted x ON x.person_id = s.person_id""", "measurement", "extracted")
def _(d: Data):
    from cohortsieve.operators.features import max_value
    stated = max_value(d.table("measurement"), "person_id", "measurement_source_value",
                       v.MARKERS["her2_status"], "value_source_value", "her2_status")
    return X.agreement(stated, d.extracted, "person_id", "her2_status")


@query("g11_fuse", "SELECT * FROM unified", "unified")
def _(d: Data):
    return d.unified


@query("g11_fuse_three_way", """
SELECT ifnull(s.person_id, x.person_id) AS person_id,
  CASE WHEN s.person_id IS NULL THEN 'nlp' WHEN x.person_id IS NULL THEN 'structured' ELSE 'both' END AS biomarker_source,
  CASE WHEN s.her2_status IS NOT NULL THEN 'structured' WHEN x.her2_status IS NOT NULL THEN 'nlp' END AS her2_status_source
FROM profile s FULL JOIN extracted x ON s.person_id = x.person_id""", "profile", "extracted")
def _(d: Data):
    return fuse.fuse(d.profile, d.extracted, "person_id", STATUS_COLUMNS, three_way=True, per_column=True) \
        .select("person_id", "biomarker_source", "her2_status_source")


@query("g12_source_counts", """
SELECT biomarker_source, count(*) AS entities FROM unified GROUP BY biomarker_source""", "unified")
def _(d: Data):
    return fuse.source_counts(d.unified)


# Screening ---------------------------------------------------------------------------------------

@query("e1_patient_frame", "SELECT * FROM patients", "patients")
def _(d: Data):
    return screen.patient_frame(d.unified, d.demographics, d.therapy)


@query("e1_patients_of_the_build", "SELECT * FROM patients", "patients")
def _(d: Data):
    return d.patients


@query("e2_screen_flags", """
SELECT person_id, trial_id, CAST(ok_sex AS VARCHAR) AS ok_sex, CAST(ok_her2 AS VARCHAR) AS ok_her2,
  CAST(ok_er AS VARCHAR) AS ok_er, CAST(ok_pr AS VARCHAR) AS ok_pr, CAST(ok_menopausal AS VARCHAR) AS ok_menopausal,
  CAST(ok_prior_anti_her2 AS VARCHAR) AS ok_prior_anti_her2, CAST(ok_age AS VARCHAR) AS ok_age FROM flagged""",
       "flagged")
def _(d: Data):
    names = ["sex", "her2", "er", "pr", "menopausal", "prior_anti_her2", "age"]
    return d.flagged.select("person_id", "trial_id", *(text(f"ok_{n}") for n in names))


@query("e3_eligible", "SELECT person_id, trial_id, first_failure IS NULL AS eligible FROM judged", "judged")
def _(d: Data):
    return d.prescreen.select("person_id", "trial_id", "eligible")


@query("e4_prescreen_reasons", """
SELECT person_id, trial_id, trial_name, trial_status, gender, age_at_dx_years, her2_status, er_status,
  pr_status, menopausal_status, ajcc_stage, prior_anti_her2, biomarker_source,
  CAST(min_ecog AS VARCHAR) AS min_ecog, eligibility_text, eligible, reason FROM prescreen""", "prescreen")
def _(d: Data):
    return d.prescreen.withColumn("min_ecog", text("min_ecog"))


@query("e5_widen", """
SELECT person_id, any_value(gender) AS gender, any_value(age_at_dx_years) AS age_at_dx_years,
  any_value(her2_status) AS her2_status, any_value(er_status) AS er_status, any_value(pr_status) AS pr_status,
  any_value(menopausal_status) AS menopausal_status, any_value(ajcc_stage) AS ajcc_stage,
  any_value(prior_anti_her2) AS prior_anti_her2, any_value(biomarker_source) AS biomarker_source,
  bool_or(eligible) FILTER (WHERE trial_id = 'A') AS trial_a_eligible,
  any_value(reason) FILTER (WHERE trial_id = 'A') AS trial_a_reason,
  bool_or(eligible) FILTER (WHERE trial_id = 'B') AS trial_b_eligible,
  any_value(reason) FILTER (WHERE trial_id = 'B') AS trial_b_reason,
  bool_or(eligible) FILTER (WHERE trial_id = 'C') AS trial_c_eligible,
  any_value(reason) FILTER (WHERE trial_id = 'C') AS trial_c_reason
FROM prescreen GROUP BY person_id""", "prescreen")
def _(d: Data):
    return d.wide


@query("e6_baseline_counts", """
SELECT 'A' AS trial_id, count(DISTINCT m.person_id) AS eligible FROM measurement m
WHERE m.measurement_source_value = 'HER2/neu' AND m.value_source_value = 'Positive'
  AND m.person_id IN (SELECT person_id FROM demographics)
  AND m.person_id NOT IN (SELECT person_id FROM drug_exposure WHERE drug_source_value IN ('Trastuzumab', 'Pertuzumab'))
UNION ALL
SELECT 'B', count(DISTINCT e.person_id) FROM measurement e JOIN measurement h ON e.person_id = h.person_id
WHERE e.measurement_source_value = 'Estrogen receptor' AND e.value_source_value = 'Positive'
  AND h.measurement_source_value = 'HER2/neu' AND h.value_source_value = 'Negative'
  AND e.person_id IN (SELECT person_id FROM observation
    WHERE observation_source_value = 'Menopausal status' AND value_source_value = 'Postmenopausal')
  AND e.person_id IN (SELECT person_id FROM demographics)""",
       "measurement", "demographics", "drug_exposure", "observation")
def _(d: Data):
    return report.baseline_counts(d.table("measurement"), d.table("condition_occurrence"),
                                  d.table("observation"), d.table("drug_exposure"))


def flagship(d: Data):
    return report.eligibility_summary(d.prescreen)


query("e7_eligibility_summary", """
SELECT trial_id, count(*) FILTER (WHERE eligible) AS eligible_patients,
  count(*) FILTER (WHERE eligible AND biomarker_source = 'nlp') AS nlp_recovered
FROM prescreen GROUP BY trial_id""", "prescreen")(flagship)


@query("e7_eligibility_by_source", """
SELECT trial_id, biomarker_source, count(*) FILTER (WHERE eligible) AS eligible_patients,
  count(*) FILTER (WHERE eligible AND biomarker_source = 'nlp') AS nlp_recovered
FROM prescreen GROUP BY trial_id, biomarker_source""", "prescreen")
def _(d: Data):
    return report.eligibility_summary(d.prescreen, ["trial_id", "biomarker_source"])


@query("e8_uplift", """
SELECT trial_id, s AS without_notes, s + n AS with_notes, n AS gain, round(100.0 * n / nullif(s, 0), 1) AS gain_pct
FROM (SELECT trial_id, count(*) FILTER (WHERE eligible AND biomarker_source <> 'nlp') AS s,
        count(*) FILTER (WHERE eligible AND biomarker_source = 'nlp') AS n FROM prescreen GROUP BY trial_id)""",
       "prescreen")
def _(d: Data):
    return report.uplift(d.prescreen)


@query("e9_exclusion_summary", """
SELECT trial_id, first_failure, count(*) AS patients FROM judged
WHERE first_failure IS NOT NULL GROUP BY trial_id, first_failure""", "judged")
def _(d: Data):
    return report.exclusion_summary(d.flagged)


@query("e10_eligible_per_trial", """
SELECT trial_id, trial_name, count(*) AS eligible_patients FROM prescreen WHERE eligible GROUP BY ALL""", "prescreen")
def _(d: Data):
    return report.eligible_per_trial(d.prescreen)


@query("e10_eligible_by_source", """
SELECT trial_id, biomarker_source, count(*) AS eligible_patients FROM prescreen WHERE eligible GROUP BY ALL""",
       "prescreen")
def _(d: Data):
    return report.eligible_by_source(d.prescreen)


@query("e10_excluded_by_therapy", """
SELECT person_id, her2_status, prior_anti_her2, reason FROM prescreen
WHERE trial_id = 'A' AND her2_status = 'Positive' AND prior_anti_her2 AND NOT eligible""", "prescreen")
def _(d: Data):
    return report.excluded_by_prior_therapy(d.prescreen)


@query("e10_eligible_with_dx_date", """
SELECT s.person_id, s.reason, CAST(d.dx_date AS VARCHAR) AS dx_date, d.age_at_dx_years
FROM prescreen s JOIN demographics d ON d.person_id = s.person_id WHERE s.trial_id = 'A' AND s.eligible""",
       "prescreen", "demographics")
def _(d: Data):
    return report.eligible_with_diagnosis_date(d.prescreen, d.demographics, "A").withColumn("dx_date", text("dx_date"))


@query("e10_postmenopausal_list", """
SELECT person_id, menopausal_status, reason FROM prescreen
WHERE trial_id = 'B' AND eligible AND menopausal_status = 'Postmenopausal'""", "prescreen")
def _(d: Data):
    return report.eligible_with_menopausal_status(d.prescreen, "B", v.POSTMENOPAUSAL)


@query("e10_age_distribution", """
SELECT CAST(floor(age_at_dx_years / 5.0) * 5 AS BIGINT) AS bin_start, count(*) AS n FROM prescreen
WHERE trial_id = 'A' AND eligible GROUP BY 1""", "prescreen")
def _(d: Data):
    from cohortsieve.operators.features import histogram
    return histogram(d.prescreen.filter("trial_id = 'A' and eligible"), "age_at_dx_years", 5)


@query("e10_distinct_patients", """
SELECT count(DISTINCT person_id) AS patients, count(*) AS "rows" FROM prescreen""", "prescreen")
def _(d: Data):
    return report.distinct_patients(d.prescreen)


@query("e11_timeline", """
SELECT person_id, CAST(measurement_date AS VARCHAR) AS measurement_date, test_name, value, unit FROM timeline""",
       "timeline")
def _(d: Data):
    return d.timeline.withColumn("measurement_date", text("measurement_date"))


@query("e11_timeline_for", """
SELECT person_id, CAST(measurement_date AS VARCHAR) AS measurement_date, test_name, value, unit FROM timeline
WHERE person_id = (SELECT min(person_id) FROM timeline)""", "timeline")
def _(d: Data):
    first = d.timeline.agg(F.min("person_id")).first()[0]
    return report.timeline_for(d.timeline, first).withColumn("measurement_date", text("measurement_date"))


@query("e12_screen_subset", """
SELECT person_id, trial_id, eligible, reason FROM prescreen
WHERE trial_id IN ('A', 'C') AND person_id IN (SELECT person_id FROM extracted)""", "prescreen", "extracted")
def _(d: Data):
    return screen.screen_subset(d.patients, d.criteria, people=d.extracted, trials=["A", "C"]) \
        .select("person_id", "trial_id", "eligible", "reason")


# A trial for late stages, added as one more row: the list of stages is its requirement.
LATE_STAGES = ["Stage IIIA", "Stage IIIB", "Stage IV"]


@query("e13_added_stage_trial", """
SELECT person_id, trial_id, eligible, reason FROM prescreen
UNION ALL
SELECT person_id, 'D', ok, CASE
  WHEN ok THEN 'Eligible: ' || ajcc_stage || ', age ' || age_at_dx_years || ' (' || biomarker_source || ')'
  WHEN ok_stage IS NOT TRUE THEN 'Excluded: ' || ifnull(ajcc_stage, 'stage unknown') || ' (need Stage IIIA or Stage IIIB or Stage IV)'
  WHEN ok_age IS NOT TRUE THEN 'Excluded: age ' || age_at_dx_years || ' outside 18 to 75'
  ELSE 'Excluded: sex ' || gender || ' (need Female)' END
FROM (SELECT *, ok_stage IS TRUE AND ok_age IS TRUE AND ok_sex IS TRUE AS ok FROM (
  SELECT *, ajcc_stage IN ('Stage IIIA', 'Stage IIIB', 'Stage IV') AS ok_stage,
    age_at_dx_years BETWEEN 18 AND 75 AS ok_age, upper(gender) = 'FEMALE' AS ok_sex FROM patients))""",
       "prescreen", "patients")
def _(d: Data):
    late = ("D", "Late-Stage Study", "Recruiting", "Female", 18, 75, None, None, None, None, None, None,
            "Stage III or IV breast cancer, age 18-75.", LATE_STAGES)
    rows = [(*t, None) for t in v.TRIALS] + [late]
    trials = criteria(d.spark, rows, v.TRIAL_COLUMNS + ", req_stage array<string>")
    return screen.screen(d.patients, trials).select("person_id", "trial_id", "eligible", "reason")


@query("e14_metrics", """
SELECT trial_id, gender, count(*) FILTER (WHERE eligible) AS eligible_count,
  count(*) FILTER (WHERE eligible AND biomarker_source = 'nlp') AS nlp_recovered_eligible
FROM prescreen GROUP BY trial_id, gender""", "prescreen")
def _(d: Data):
    return report.query_metrics(d.prescreen, ["eligible_count", "nlp_recovered_eligible"], ["trial_id", "gender"])


@query("e15_eligible_list", """
SELECT person_id, age_at_dx_years, her2_status, er_status, pr_status, menopausal_status, reason, biomarker_source
FROM prescreen WHERE trial_id = 'B' AND eligible""", "prescreen")
def _(d: Data):
    return report.eligible_list(d.prescreen, "B", "age_at_dx_years")


# Evaluation --------------------------------------------------------------------------------------

@query("v1_goldset", "SELECT * FROM goldset", "goldset")
def _(d: Data):
    return d.goldset


ACCURACY_SQL = """
round(count(*) FILTER (WHERE gold_her2 = pred_her2) / count(gold_her2), 4) AS her2_acc,
round(count(*) FILTER (WHERE gold_er = pred_er) / count(gold_er), 4) AS er_acc,
round(count(*) FILTER (WHERE gold_pr = pred_pr) / count(gold_pr), 4) AS pr_acc,
round((count(*) FILTER (WHERE gold_her2 = pred_her2) / count(gold_her2)
  + count(*) FILTER (WHERE gold_er = pred_er) / count(gold_er)
  + count(*) FILTER (WHERE gold_pr = pred_pr) / count(gold_pr)) / 3.0, 4) AS overall_acc"""


@query("v2_accuracy", f"SELECT {ACCURACY_SQL} FROM preds WHERE config = 'careful'", "preds")
def _(d: Data):
    return V.accuracy(V.predict(d.goldset, {"careful": R.CAREFUL}))


@query("v3_leaderboard", f"SELECT config, {ACCURACY_SQL} FROM preds GROUP BY config", "preds")
def _(d: Data):
    return V.leaderboard(d.goldset, BOTH_RULES)


@query("v4_best", f"""
SELECT config, {ACCURACY_SQL} FROM preds GROUP BY config ORDER BY overall_acc DESC, config LIMIT 1""", "preds")
def _(d: Data):
    return V.best(V.leaderboard(d.goldset, BOTH_RULES))


@query("v5_errors", """
SELECT person_id, config, marker, predicted, actual, note_text[1:220] AS note_snippet FROM pairs
WHERE actual <> predicted""", "pairs")
def _(d: Data):
    return V.errors(V.predict(d.goldset, BOTH_RULES), carry=["person_id", "config"])


def hard():
    return F.col("note_text").contains("equivocal by IHC")


@query("v6_head_to_head", """
SELECT person_id, gold_her2, t.pred_her2 AS terse_her2, CAST(t.pred_her2 = gold_her2 AS VARCHAR) AS terse_ok,
  c.pred_her2 AS careful_her2, CAST(c.pred_her2 = gold_her2 AS VARCHAR) AS careful_ok,
  t.note_text[1:180] AS note_snippet
FROM (SELECT * FROM preds WHERE config = 'terse') t
JOIN (SELECT person_id, pred_her2 FROM preds WHERE config = 'careful') c USING (person_id)
WHERE t.note_text LIKE '%equivocal by IHC%'""", "preds")
def _(d: Data):
    return V.rules_head_to_head(d.goldset, {n: BOTH_RULES[n] for n in ("terse", "careful")}, "her2", hard()) \
        .withColumns({"terse_ok": text("terse_ok"), "careful_ok": text("careful_ok")})


SCORES_SQL = """
SELECT person_id, config, CAST(gold_her2 IS NOT DISTINCT FROM pred_her2 AS INT)::DOUBLE AS her2_exact_match,
  round((ifnull(gold_her2 = pred_her2, false)::INT + ifnull(gold_er = pred_er, false)::INT
    + ifnull(gold_pr = pred_pr, false)::INT)
   / ((gold_her2 IS NOT NULL)::INT + (gold_er IS NOT NULL)::INT + (gold_pr IS NOT NULL)::INT), 4) AS biomarker_agreement,
  CAST(pred_her2 IN ('Positive', 'Negative', 'Unknown') AND pred_er IN ('Positive', 'Negative', 'Unknown')
    AND pred_pr IN ('Positive', 'Negative', 'Unknown') AS INT)::DOUBLE AS valid_status_values FROM preds"""


@query("v7_row_scores", SCORES_SQL, "preds")
def _(d: Data):
    scored = V.Scorers().score_rows(V.predict(d.goldset, BOTH_RULES))
    return scored.select("person_id", "config", "her2_exact_match",
                         F.round("biomarker_agreement", 4).alias("biomarker_agreement"), "valid_status_values")


@query("v8_case_types", """
SELECT CASE WHEN note_text LIKE '%equivocal by IHC%' THEN 'hard' ELSE 'clear' END AS case_type, config,
  round(count(*) FILTER (WHERE gold_her2 = pred_her2) / count(gold_her2), 4) AS her2_acc,
  round(count(*) FILTER (WHERE gold_her2 = pred_her2) / count(gold_her2), 4) AS overall_acc
FROM preds GROUP BY ALL""", "preds")
def _(d: Data):
    typed = V.with_case_type(V.predict(d.goldset, BOTH_RULES), hard())
    return V.accuracy(typed, ["her2"], by=["case_type", "config"])


@query("v9_compare_metrics", """
SELECT 'her2_exact_match' AS metric, round(avg(m) FILTER (WHERE config = 'terse'), 4) AS terse,
  round(avg(m) FILTER (WHERE config = 'careful'), 4) AS careful
FROM (SELECT config, CAST(gold_her2 IS NOT DISTINCT FROM pred_her2 AS INT) AS m FROM preds)
UNION ALL
SELECT 'biomarker_agreement', round(avg(m) FILTER (WHERE config = 'terse'), 4), round(avg(m) FILTER (WHERE config = 'careful'), 4)
FROM (SELECT config, (ifnull(gold_her2 = pred_her2, false)::INT + ifnull(gold_er = pred_er, false)::INT
    + ifnull(gold_pr = pred_pr, false)::INT)
   / ((gold_her2 IS NOT NULL)::INT + (gold_er IS NOT NULL)::INT + (gold_pr IS NOT NULL)::INT) AS m FROM preds)
UNION ALL SELECT 'valid_status_values', 1.0, 1.0""", "preds")
def _(d: Data):
    return V.compare_metrics(V.Scorers().means(V.predict(d.goldset, BOTH_RULES)), ["terse", "careful"])


@query("v10_record_run", f"""
SELECT 'careful' AS run, '{{"rules":"careful","text":"note_text"}}' AS params, {ACCURACY_SQL} FROM preds WHERE config = 'careful'
UNION ALL
SELECT 'terse', '{{"rules":"terse","text":"note_text"}}', {ACCURACY_SQL} FROM preds WHERE config = 'terse'""", "preds")
def _(d: Data):
    path = new_folder(d.spark, "runs")
    for name, rules in BOTH_RULES.items():
        board = V.leaderboard(d.goldset, {name: rules}).withColumnRenamed("config", "run")
        V.record_run(board, path, {"rules": name, "text": "note_text"})
    return d.spark.read.parquet(path)


@query("v11_confusion", """
SELECT config, marker, actual, predicted, count(*) AS n FROM pairs GROUP BY ALL""", "pairs")
def _(d: Data):
    return V.confusion(V.predict(d.goldset, BOTH_RULES), by=["config"])


@query("v11_quality_confusion", """
SELECT quality, length(text) >= 400 AS long_text, count(*) AS n FROM labels
JOIN documents ON documents.doc_id = labels.doc_id GROUP BY ALL""")
def _(d: Data):
    """Another gold set: the quality labels against a plain length rule."""
    return d.raw("labels").join(d.raw("documents").select("doc_id", (F.length("text") >= 400).alias("long_text")), "doc_id") \
        .groupBy("quality", "long_text").agg(F.count(F.lit(1)).alias("n"))




@query("u2_registered_scorer", """
SELECT config, round(avg((pred_er = 'Positive')::INT), 4) AS er_positive_share FROM preds GROUP BY config""", "preds")
def _(d: Data):
    scorers = V.Scorers().register("er_positive_share", lambda: (F.col("pred_er") == v.POSITIVE).cast("double"))
    return scorers.means(V.predict(d.goldset, BOTH_RULES)).filter("metric = 'er_positive_share'") \
        .select("config", F.round("value", 4).alias("er_positive_share"))


# Embeddings --------------------------------------------------------------------------------------

def letter_counts(texts: pd.Series) -> pd.Series:
    """A stand-in for a user's embedding model: how often each of eight letters occurs."""
    return texts.map(lambda t: [float(t.count(c)) for c in "etaoinsr"])


@query("m1_embed_with", """
SELECT note_id, 8 AS dim, CAST(length(note_text) - length(replace(note_text, 'e', '')) AS DOUBLE) AS first_value
FROM note WHERE note_source_value = 'PATHOLOGY_REPORT'""", "note")
def _(d: Data):
    return similar.embed_with(d.reports.select("note_id", "note_text"), "note_text", letter_counts,
                              partitions=d.spark.sparkContext.defaultParallelism) \
        .select("note_id", F.size("embedding").alias("dim"),
                F.col("embedding")[0].cast("double").alias("first_value"))


@query("m2_hash_embed", r"""
SELECT note_id, CAST(64 AS INT) AS dim, CASE WHEN regexp_matches(note_text, '[\p{L}\p{N}]') THEN 1.0::DOUBLE ELSE 0.0 END AS self_similarity
FROM note WHERE note_source_value = 'PATHOLOGY_REPORT'""", "note")
def _(d: Data):
    return similar.hash_embed(d.reports.select("note_id", "note_text"), "note_text") \
        .select("note_id", F.size("embedding").alias("dim"),
                F.round(cosine(F.col("embedding"), F.col("embedding")), 4).alias("self_similarity"))


@query("m3_cosine", """
SELECT a.vec_id, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
   / (greatest(sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])), 1e-9)
    * greatest(sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 1e-9)), 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def _(d: Data):
    vectors = d.raw("embeddings")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return vectors.join(following, "vec_id") \
        .select("vec_id", F.round(cosine(F.col("embedding"), F.col("next")), 6).alias("similarity"))


@query("m4_similar_to", """
SELECT neighbour_id AS vec_id, similarity FROM similarities WHERE vec_id = 0
ORDER BY similarity DESC, neighbour_id LIMIT 3""", "similarities")
def _(d: Data):
    return similar.similar_to(d.raw("embeddings"), "vec_id", "embedding", 0, 3)


@query("m5_similar_all", "SELECT vec_id, neighbour_id, similarity, rank FROM neighbours", "neighbours")
def _(d: Data):
    return similar.similar_all(d.raw("embeddings"), "vec_id", "embedding", 5)


@query("m5_candidate_recall", """
SELECT CAST(count(*) AS BIGINT) AS wanted, true AS enough FROM neighbours WHERE vec_id % 100 = 0""", "neighbours")
def _(d: Data):
    """Approximate neighbours of the ids divisible by 100, among all rows, held against the exact ones."""
    asks = F.col("vec_id") % 100 == 0
    exact = similar.similar_all(d.raw("embeddings"), "vec_id", "embedding", 5, queries=asks)
    found = similar.similar_candidates(d.raw("embeddings"), "vec_id", "embedding", asks, 5, tables=64, bits=5)
    return similar.recall_at(found, exact, "vec_id").select("wanted", (F.col("recall") >= 0.9).alias("enough"))


def patients_alike(d: Data):
    """The five patients whose notes are most like a patient's own."""
    embedded = similar.embed_with(d.reports.select("person_id", "note_text"), "note_text", letter_counts,
                                  partitions=d.spark.sparkContext.defaultParallelism)
    return similar.similar_entities(embedded, "person_id", "embedding", 5)


@query("m6_similar_patients", "SELECT person_id, neighbour_id, similarity, rank FROM patients_alike", "patients_alike")
def _(d: Data):
    return patients_alike(d)


@query("m6_expand_cohort", """
SELECT neighbour_id AS candidate_id, count(*) AS near_eligible, max(similarity) AS best_similarity FROM patients_alike
WHERE person_id IN (SELECT person_id FROM prescreen WHERE eligible)
  AND neighbour_id NOT IN (SELECT person_id FROM prescreen WHERE eligible) GROUP BY neighbour_id""",
       "patients_alike", "prescreen")
def _(d: Data):
    return similar.expand_cohort(patients_alike(d), "person_id", d.prescreen.filter("eligible"))


@query("m7_prioritise", """
SELECT trial_id, person_id, score, row_number() OVER (PARTITION BY trial_id ORDER BY score DESC, person_id) AS priority
FROM (SELECT s.trial_id, s.person_id, round(
    0.4 * ifnull(1.0 / (1.0 + greatest(date_diff('day', seen, DATE '2000-01-01'), 0) / 365.0), 0.0)
    + 0.3 * CASE WHEN biomarker_source = 'nlp' THEN 0.0 ELSE 1.0 END
    + 0.2 * ifnull(CASE ajcc_stage WHEN 'Stage I' THEN 1 / 6.0 WHEN 'Stage IIA' THEN 2 / 6.0 WHEN 'Stage IIB' THEN 3 / 6.0
        WHEN 'Stage IIIA' THEN 4 / 6.0 WHEN 'Stage IIIB' THEN 5 / 6.0 WHEN 'Stage IV' THEN 1.0 END, 0.0)
    + 0.1 * greatest(0.0, 1.0 - age_at_dx_years / 100.0), 6) AS score
  FROM prescreen s LEFT JOIN (SELECT person_id, max(measurement_date) AS seen FROM timeline GROUP BY person_id) t
    ON t.person_id = s.person_id WHERE s.eligible)""", "prescreen", "timeline")
def _(d: Data):
    return similar.prioritise(d.prescreen, d.last_seen, "2000-01-01")


@query("m7_training_rows", """
SELECT s.person_id, s.trial_id, CASE WHEN l.decision = 'approved' THEN 1.0 ELSE 0.0 END AS label,
  round(ifnull(1.0 / (1.0 + greatest(date_diff('day', seen, DATE '2000-01-01'), 0) / 365.0), 0.0), 6) AS recency,
  CASE WHEN biomarker_source = 'nlp' THEN 0.0 ELSE 1.0 END AS source, round(greatest(0.0, 1.0 - age_at_dx_years / 100.0), 6) AS age
FROM prescreen s JOIN latest_review l ON l.person_id = s.person_id AND l.trial_id = s.trial_id
LEFT JOIN (SELECT person_id, max(measurement_date) AS seen FROM timeline GROUP BY person_id) t ON t.person_id = s.person_id
WHERE s.eligible AND l.decision IN ('approved', 'rejected')""", "prescreen", "latest_review", "timeline")
def _(d: Data):
    rows = ranker.training_rows(d.prescreen, d.last_seen, d.table("review"), "2000-01-01")
    return rows.select("person_id", "trial_id", "label", F.round("recency", 6).alias("recency"), F.col("source").cast("double").alias("source"),
                       F.round("age", 6).alias("age"))


@query("m7_learnt_order", """
SELECT trial_id, count(*) AS patients, count(*) AS last_priority, true AS falls, true AS auc_known FROM prescreen WHERE eligible GROUP BY trial_id""", "prescreen")
def _(d: Data):
    """Learnt from the review log, by trial: every eligible patient has a place, and scores fall along them."""
    # Both steps read the eligible rows and their dates, so the build runs once.
    long = cut_lineage(d.prescreen.filter("eligible").select(*review.KEYS, "eligible", "biomarker_source", "ajcc_stage", "age_at_dx_years"), "eligible")
    seen = cut_lineage(d.last_seen.join(long.select("person_id").distinct(), "person_id", "left_semi"), "last-seen")
    model = ranker.fit_ranker(ranker.training_rows(long, seen, d.table("review"), "2000-01-01"))
    order = ranker.prioritise_learnt(long, seen, "2000-01-01", model)
    next_ = order.select("trial_id", (F.col("priority") - 1).alias("priority"), F.col("score").alias("next_score"))
    known = F.lit(model.auc is not None and 0.0 <= model.auc <= 1.0)
    return order.join(next_, ["trial_id", "priority"], "left").groupBy("trial_id").agg(
        F.count(F.lit(1)).alias("patients"), F.max("priority").alias("last_priority"),
        F.every(F.coalesce(F.col("score") >= F.col("next_score"), F.lit(True))).alias("falls")).withColumn("auc_known", known)


# Review ------------------------------------------------------------------------------------------

@query("r1_record_reviews", """
SELECT person_id, trial_id, review_id, decision FROM latest_review""", "latest_review")
def _(d: Data):
    """The log kept so far, and the decisions that came in after it, merged."""
    reviews = d.table("review")
    kept = review.record_reviews(None, reviews.filter("reasoning <> 'purchase'"))
    return review.record_reviews(kept, reviews.filter("reasoning = 'purchase'")) \
        .select("person_id", "trial_id", "review_id", "decision")


@query("r2_latest_by", """
SELECT person_id, trial_id, review_id, decision, reasoning FROM latest_review""", "latest_review")
def _(d: Data):
    return review.latest_by(d.table("review"), review.KEYS, review.newest_first()) \
        .select("person_id", "trial_id", "review_id", "decision", "reasoning")


@query("r3_effective", """
SELECT s.person_id, s.trial_id, s.eligible, r.decision,
  CASE WHEN r.decision IS NULL THEN s.eligible ELSE r.decision = 'approved' END AS effective_eligible
FROM prescreen s LEFT JOIN latest_review r USING (person_id, trial_id)""", "prescreen", "latest_review")
def _(d: Data):
    return review.effective(d.prescreen, d.table("review")) \
        .select("person_id", "trial_id", "eligible", "decision", "effective_eligible")


@query("r4_review_summary", """
SELECT trial_id, count(*) FILTER (WHERE eligible AND decision IS NOT NULL) AS eligible_reviewed,
  count(*) FILTER (WHERE eligible AND decision IS NULL) AS eligible_not_reviewed,
  count(*) FILTER (WHERE decision = 'approved') AS approved, count(*) FILTER (WHERE decision = 'rejected') AS rejected,
  count(*) FILTER (WHERE (decision = 'approved') = eligible) AS agrees_with_model
FROM prescreen LEFT JOIN latest_review USING (person_id, trial_id) GROUP BY trial_id""", "prescreen", "latest_review")
def _(d: Data):
    return review.review_summary(d.prescreen, d.table("review"))


# Streaming and user functions ----------------------------------------------------------------------

def streamed(d: Data, raw: str, view: str):
    """A fixture view over a streaming read of its one table."""
    from cohortsieve.sources.fixtures import VIEWS
    path = d.source.path(raw)
    # As a pattern that matches just this path: a stream takes a single file only that way.
    rows = d.spark.readStream.schema(d.raw(raw).schema).parquet(f"{path[:-1]}[{path[-1]}]")
    return d.spark.sql(VIEWS[view], **{raw: rows})


@query("t1_stream_extract", """
SELECT note_id, person_id, her2_status, er_status, pr_status FROM read_careful
WHERE note_source_value = 'PATHOLOGY_REPORT'""", "read_careful")
def _(d: Data):
    out = new_folder(d.spark, "stream-extract")
    incremental.stream_extract(streamed(d, "documents", "note"), f"{out}/rows", f"{out}/state")
    return d.spark.read.parquet(f"{out}/rows")


@query("t2_full_refresh", """
SELECT note_id, person_id, her2_status, er_status, pr_status FROM read_careful
WHERE note_source_value = 'PATHOLOGY_REPORT'""", "read_careful")
def _(d: Data):
    """First filled by the terse rules, then rebuilt by the careful ones."""
    table = incremental.ExtractionTable(d.spark, new_folder(d.spark, "extraction"))
    table.update(streamed(d, "documents", "note"), R.TERSE)
    table.full_refresh(streamed(d, "documents", "note"), R.CAREFUL)
    return table.read()


@query("t3_stream_reviews", """
SELECT person_id, trial_id, review_id, decision FROM latest_review""", "latest_review")
def _(d: Data):
    out = new_folder(d.spark, "stream-reviews")
    incremental.stream_reviews(streamed(d, "events", "review"), f"{out}/rows", f"{out}/state")
    return incremental.read_reviews(d.spark, f"{out}/rows").select("person_id", "trial_id", "review_id", "decision")


def count_strong(texts: pd.Series) -> pd.Series:
    """A stand-in for a user's model: answers in fenced JSON, as such models do."""
    strong = re.compile(r"3\+|amplified")
    return texts.map(lambda t: '```json\n{"result": {"strong_mentions": %d, "length": %d}}\n```'
                     % (len(strong.findall(t)), len(t)))


@query("u1_extract_with", """
SELECT note_id, CAST(len(regexp_extract_all(note_text, '3\\+|amplified')) AS INT) AS strong_mentions,
  CAST(length(note_text) AS INT) AS length FROM note""", "note")
def _(d: Data):
    return X.extract_with(d.table("note"), "note_text", count_strong, "strong_mentions int, length int",
                          partitions=d.spark.sparkContext.defaultParallelism) \
        .select("note_id", "strong_mentions", "length")
