"""Predicates, scalar functions, feature aggregates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortsieve import vocabulary as v
from cohortsieve.functions.vectors import norm
from cohortsieve.operators import coverage as G
from cohortsieve.operators import features as A
from cohortsieve.operators.review import effective, latest_by
from cohortsieve.plans.registry import Data, query, text


@query("f1_predicates", """
SELECT person_id, measurement_id FROM measurement
WHERE measurement_source_value IN ('HER2/neu', 'Estrogen receptor') AND value_source_value IS NOT NULL
  AND value_as_number BETWEEN 10 AND 40 AND NOT (value_source_value = 'Negative' OR person_id IS NULL)""",
       "measurement")
def _(d: Data):
    m = d.table("measurement")
    return m.filter(m.measurement_source_value.isin(v.MARKERS["her2_status"], v.MARKERS["er_status"])
                    & m.value_source_value.isNotNull() & m.value_as_number.between(10, 40)
                    & ~((m.value_source_value == v.NEGATIVE) | m.person_id.isNull())) \
        .select("person_id", "measurement_id")


@query("f2_like", "SELECT note_id FROM note WHERE note_text LIKE '%equivocal by IHC%'", "note")
def _(d: Data):
    return d.table("note").filter(F.col("note_text").like("%equivocal by IHC%")).select("note_id")


@query("f3_case", """
SELECT person_id, CASE WHEN year_of_birth < 1940 THEN 'before 1940' WHEN year_of_birth < 1965 THEN '1940-1964'
  ELSE '1965 and later' END AS cohort,
  CASE WHEN gender_source_value = 'MALE' THEN 'M' END AS male_only FROM person""", "person")
def _(d: Data):
    born = F.col("year_of_birth")
    return d.table("person").select(
        "person_id",
        F.when(born < 1940, "before 1940").when(born < 1965, "1940-1964").otherwise("1965 and later").alias("cohort"),
        F.when(F.col("gender_source_value") == "MALE", "M").alias("male_only"))


@query("f4_coalesce", """
SELECT d.person_id, ifnull(menopausal_status, '(unknown)') AS menopausal_status,
  ifnull(had_anti_her2_therapy, false) AS treated
FROM demographics d LEFT JOIN therapy t ON t.person_id = d.person_id""", "demographics", "therapy")
def _(d: Data):
    return d.demographics.join(d.therapy, "person_id", "left").select(
        "person_id", F.coalesce("menopausal_status", F.lit("(unknown)")).alias("menopausal_status"),
        F.coalesce("had_anti_her2_therapy", F.lit(False)).alias("treated"))


@query("f5_flag_from_aggregate", """
SELECT person_id, bool_or(value_source_value = 'Stage IV') AS ever_stage_iv
FROM observation WHERE observation_source_value = 'AJCC stage' GROUP BY person_id""", "observation")
def _(d: Data):
    staged = d.table("observation").filter(F.col("observation_source_value") == v.OBSERVATIONS["ajcc_stage"])
    return A.flag_any(staged, "person_id", "value_source_value", {"ever_stage_iv": ["Stage IV"]})


@query("f6_literal_tag", "SELECT vec_id, 'hashed' AS model_source FROM embeddings")
def _(d: Data):
    return d.raw("embeddings").select("vec_id", F.lit("hashed").alias("model_source"))


@query("f7_case_insensitive", """
SELECT person_id FROM person WHERE lower(gender_source_value) = 'female'""", "person")
def _(d: Data):
    return d.table("person").filter(F.upper("gender_source_value") == F.upper(F.lit("Female"))).select("person_id")


@query("f8_concat", """
SELECT person_id, 'HER2 ' || her2_status || ' / ER ' || er_status AS strict_text,
  concat_ws(', ', her2_status, er_status, pr_status) AS loose_text FROM profile""", "profile")
def _(d: Data):
    return d.profile.select(
        "person_id",
        F.concat(F.lit("HER2 "), "her2_status", F.lit(" / ER "), "er_status").alias("strict_text"),
        F.concat_ws(", ", "her2_status", "er_status", "pr_status").alias("loose_text"))


@query("f9_snippet", "SELECT note_id, note_text[1:220] AS snippet FROM note", "note")
def _(d: Data):
    """The snippet shown next to a finding; readings always use the whole text."""
    return d.table("note").select("note_id", F.substring("note_text", 1, 220).alias("snippet"))


@query("f10_dates", """
SELECT person_id, CAST(year(condition_start_date) AS INT) AS dx_year,
  CAST(condition_start_date - INTERVAL 30 DAY AS DATE)::VARCHAR AS window_start FROM condition_occurrence""",
       "condition_occurrence")
def _(d: Data):
    return d.table("condition_occurrence").select(
        "person_id", F.year("condition_start_date").alias("dx_year"),
        F.date_sub("condition_start_date", 30).cast("string").alias("window_start"))


@query("f11_number_as_text", """
SELECT measurement_id, ifnull(value_source_value, format('{:.1f}', value_as_number)) AS value FROM measurement""",
       "measurement")
def _(d: Data):
    return d.table("measurement").select(
        "measurement_id",
        F.coalesce("value_source_value", F.format_string("%.1f", "value_as_number")).alias("value"))


@query("f12_rounded_share", """
SELECT event_type, round(100.0 * count(*) FILTER (WHERE value > 50) / count(*), 1) AS above_50_pct
FROM events GROUP BY event_type""")
def _(d: Data):
    return d.raw("events").groupBy("event_type").agg(
        F.round(100.0 * F.avg(F.when(F.col("value") > 50, 1).otherwise(0)), 1).alias("above_50_pct"))


@query("f13_from_json", "SELECT event_id, CAST(props::JSON->>'k' AS INT) AS k FROM events")
def _(d: Data):
    return d.raw("events").withColumn("p", F.from_json("props", "k int")).select("event_id", F.col("p.k").alias("k"))


@query("f14_array_struct", """
SELECT person_id, 'HER2' AS marker, her2_status AS status FROM profile
UNION ALL SELECT person_id, 'ER', er_status FROM profile UNION ALL SELECT person_id, 'PR', pr_status FROM profile""",
       "profile")
def _(d: Data):
    cells = F.array(*(F.struct(F.lit(label).alias("marker"), F.col(c).alias("status"))
                      for c, label in v.MARKER_LABELS.items()))
    return d.profile.select("person_id", F.explode(cells).alias("m")).select("person_id", "m.marker", "m.status")


@query("f15_stamped", "SELECT person_id, trial_id, true AS has_user, true AS is_recent, true AS one_time FROM prescreen", "prescreen")
def _(d: Data):
    """Every screened row with who screened it and when; shown as what must hold of the stamps, whoever runs it and when."""
    stamped = d.prescreen.select("person_id", "trial_id", F.current_user().alias("by"), F.current_timestamp().alias("at"), F.current_timestamp().alias("again"))
    return stamped.select("person_id", "trial_id", (F.length("by") > 0).alias("has_user"), (F.col("at").cast("date") >= F.lit("2024-01-01").cast("date")).alias("is_recent"),
                          (F.col("at") == F.col("again")).alias("one_time"))


@query("f16_typed_null", """
SELECT person_id, CAST(NULL AS VARCHAR) AS req_stage, CAST(NULL AS INT) AS min_ecog FROM person""", "person")
def _(d: Data):
    return d.table("person").select("person_id", F.lit(None).cast("string").alias("req_stage"),
                                    F.lit(None).cast("int").alias("min_ecog"))


@query("a1_pivot_long", "SELECT * FROM profile", "profile")
def _(d: Data):
    return d.profile


@query("a2_flag_any", "SELECT * FROM therapy", "therapy")
def _(d: Data):
    return d.therapy


@query("a3_first_event", """
SELECT person_id, CAST(min(condition_start_date) AS VARCHAR) AS dx_date FROM condition_occurrence
WHERE condition_source_value = 'Malignant neoplasm of breast' GROUP BY person_id""", "condition_occurrence")
def _(d: Data):
    return A.first_event(d.table("condition_occurrence"), "person_id", "condition_start_date",
                         F.col("condition_source_value") == v.DIAGNOSIS, "dx_date") \
        .select("person_id", text("dx_date"))


@query("a4_max_value", """
SELECT person_id, max(value_source_value) AS ajcc_stage FROM observation
WHERE observation_source_value = 'AJCC stage' GROUP BY person_id""", "observation")
def _(d: Data):
    return A.max_value(d.table("observation"), "person_id", "observation_source_value", "AJCC stage",
                       "value_source_value", "ajcc_stage")


@query("a5_demographics", """
SELECT person_id, gender_source_value, age_at_dx_years, CAST(dx_date AS VARCHAR) AS dx_date,
  menopausal_status, ajcc_stage FROM demographics""", "demographics")
def _(d: Data):
    return d.demographics.withColumn("dx_date", text("dx_date"))


@query("a6_counts", """
SELECT measurement_source_value, count(*) AS n, count(DISTINCT person_id) AS persons,
  count(*) FILTER (WHERE value_source_value = 'Positive') AS positives,
  round(avg(CASE WHEN value_source_value = 'Positive' THEN 1.0 ELSE 0.0 END), 4) AS positive_share,
  min(value_as_number) AS lowest, max(value_as_number) AS highest
FROM measurement GROUP BY measurement_source_value""", "measurement")
def _(d: Data):
    positive = F.when(F.col("value_source_value") == v.POSITIVE, 1).otherwise(0)
    return d.table("measurement").groupBy("measurement_source_value").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("person_id").alias("persons"), F.sum(positive).alias("positives"),
        F.round(F.avg(positive), 4).alias("positive_share"),
        F.min("value_as_number").alias("lowest"), F.max("value_as_number").alias("highest"))


@query("a7_group_by_all", """
SELECT gender_source_value, ajcc_stage, count(*) AS n FROM demographics
GROUP BY gender_source_value, ajcc_stage""", "demographics")
def _(d: Data):
    return d.spark.sql("SELECT gender_source_value, ajcc_stage, count(*) AS n FROM {people} GROUP BY ALL",
                       people=d.demographics)


@query("a8_category_counts", """
SELECT ifnull(menopausal_status, '(unknown)') AS menopausal_status, count(*) AS n FROM demographics GROUP BY ALL""",
       "demographics")
def _(d: Data):
    return A.category_counts(d.demographics, "menopausal_status", "(unknown)")


@query("a8_stage_counts", """
SELECT ajcc_stage, count(*) AS n FROM demographics WHERE ajcc_stage IS NOT NULL GROUP BY ajcc_stage""",
       "demographics")
def _(d: Data):
    return A.category_counts(d.demographics, "ajcc_stage")


@query("a9_status_matrix", """
SELECT marker, ifnull(status, '(missing)') AS status, count(*) AS n FROM (
  SELECT 'HER2' AS marker, her2_status AS status FROM profile
  UNION ALL SELECT 'ER', er_status FROM profile UNION ALL SELECT 'PR', pr_status FROM profile)
GROUP BY ALL""", "profile")
def _(d: Data):
    return A.status_matrix(d.profile)


@query("a10_histogram", """
SELECT CAST(floor(age_at_dx_years / 10.0) * 10 AS BIGINT) AS bin_start, count(*) AS n
FROM demographics WHERE age_at_dx_years IS NOT NULL GROUP BY 1""", "demographics")
def _(d: Data):
    return A.histogram(d.demographics, "age_at_dx_years", 10)


@query("a11_top_codes", """
SELECT drug_source_value, count(*) AS n FROM drug_exposure GROUP BY drug_source_value
ORDER BY n DESC, drug_source_value LIMIT 3""", "drug_exposure")
def _(d: Data):
    return A.top_codes(d.table("drug_exposure"), "drug_source_value", 3)


@query("a12_carried_value", """
SELECT person_id, any_value(gender) AS gender, count(*) FILTER (WHERE eligible) AS trials_open
FROM prescreen GROUP BY person_id""", "prescreen")
def _(d: Data):
    return d.prescreen.groupBy("person_id").agg(
        F.max("gender").alias("gender"), F.count(F.when(F.col("eligible"), 1)).alias("trials_open"))


@query("j1_inner_with_code", """
SELECT count(DISTINCT m.person_id) AS persons FROM measurement m, condition_occurrence c
WHERE m.person_id = c.person_id AND c.condition_source_value = 'Malignant neoplasm of breast'
  AND m.measurement_source_value = 'HER2/neu' AND m.value_source_value = 'Positive'""",
       "measurement", "condition_occurrence")
def _(d: Data):
    positive = d.table("measurement").filter(
        (F.col("measurement_source_value") == v.MARKERS["her2_status"])
        & (F.col("value_source_value") == v.POSITIVE)).select("person_id").distinct()
    diagnosed = d.table("condition_occurrence").filter(F.col("condition_source_value") == v.DIAGNOSIS) \
        .select("person_id").distinct()
    return positive.join(diagnosed, "person_id").agg(F.count(F.lit(1)).alias("persons"))


@query("j2_two_facts_of_one_entity", """
SELECT DISTINCT e.person_id FROM measurement e JOIN measurement h ON h.person_id = e.person_id
WHERE e.measurement_source_value = 'Estrogen receptor' AND e.value_source_value = 'Positive'
  AND h.measurement_source_value = 'HER2/neu' AND h.value_source_value = 'Negative'""", "measurement")
def _(d: Data):
    def has(marker, status):
        return F.max(F.when((F.col("measurement_source_value") == v.MARKERS[marker])
                            & (F.col("value_source_value") == status), 1).otherwise(0))
    return d.table("measurement").groupBy("person_id").agg(
        has("er_status", v.POSITIVE).alias("er"), has("her2_status", v.NEGATIVE).alias("her2")) \
        .filter("er = 1 and her2 = 1").select("person_id")


@query("j3_left_joins", """
SELECT p.person_id, her2_status, had_endocrine_therapy::VARCHAR AS had_endocrine_therapy
FROM person p LEFT JOIN profile b ON b.person_id = p.person_id
LEFT JOIN therapy t ON t.person_id = p.person_id""", "person", "profile", "therapy")
def _(d: Data):
    return d.table("person").join(d.profile, "person_id", "left").join(d.therapy, "person_id", "left") \
        .select("person_id", "her2_status", text("had_endocrine_therapy"))


@query("j4_full_outer", """
SELECT ifnull(a.person_id, b.person_id) AS person_id, a.her2_status AS stated, b.her2_status AS read
FROM profile a FULL JOIN extracted b ON a.person_id = b.person_id""", "profile", "extracted")
def _(d: Data):
    return d.profile.select("person_id", F.col("her2_status").alias("stated")).join(
        d.extracted.select("person_id", F.col("her2_status").alias("read")), "person_id", "full")


@query("j5_every_patient_every_trial", """
SELECT person_id, trial_id, age_min, age_max FROM patients CROSS JOIN trials""", "patients", "trials")
def _(d: Data):
    from cohortsieve.operators.screen import with_trials
    return with_trials(d.patients.select("person_id"), d.criteria).select("person_id", "trial_id", "age_min", "age_max")


@query("j6_not_in", """
SELECT person_id, note_id FROM note WHERE note_source_value = 'PATHOLOGY_REPORT' AND person_id NOT IN (
  SELECT person_id FROM measurement
  WHERE measurement_source_value IN ('HER2/neu', 'Estrogen receptor', 'Progesterone receptor'))""",
       "note", "measurement")
def _(d: Data):
    stated = d.table("measurement").filter(F.col("measurement_source_value").isin(list(v.MARKERS.values())))
    return G.not_in(d.reports.select("person_id", "note_id"), "person_id", stated)


@query("j6_not_in_with_null", """
SELECT person_id FROM person WHERE person_id NOT IN (
  SELECT CASE WHEN value > 0 THEN user_id END FROM events)""", "person")
def _(d: Data):
    listed = d.raw("events").select(F.when(F.col("value") > 0, F.col("user_id")).alias("user_id"))
    return G.not_in(d.table("person").select("person_id"), "person_id", listed, "user_id")


@query("j7_presence", """
SELECT person_id, EXISTS (SELECT 1 FROM profile s WHERE s.person_id = p.person_id) AS in_left,
  EXISTS (SELECT 1 FROM extracted x WHERE x.person_id = p.person_id) AS in_right FROM person p""",
       "person", "profile", "extracted")
def _(d: Data):
    return G.presence(d.table("person"), d.profile, d.reports, "person_id")


@query("j8_many_to_one", """
SELECT s.person_id, s.trial_id, s.eligible, CAST(d.dx_date AS VARCHAR) AS dx_date, u.her2_status
FROM prescreen s, demographics d, unified u WHERE s.person_id = d.person_id AND s.person_id = u.person_id""",
       "prescreen", "demographics", "unified")
def _(d: Data):
    return d.prescreen.select("person_id", "trial_id", "eligible") \
        .join(d.demographics.select("person_id", text("dx_date")), "person_id") \
        .join(d.unified.select("person_id", "her2_status"), "person_id")


@query("j9_vectors_and_notes", """
SELECT note_id, person_id, label, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 4) AS norm
FROM note JOIN embeddings ON vec_id = note_id""", "note")
def _(d: Data):
    vectors = d.raw("embeddings").withColumnRenamed("vec_id", "note_id")
    return d.table("note").select("note_id", "person_id").join(vectors, "note_id") \
        .select("note_id", "person_id", "label", F.round(norm(F.col("embedding")), 4).alias("norm"))


@query("j10_two_predictions", """
SELECT t.note_id, t.her2_status AS terse_her2, c.her2_status AS careful_her2
FROM read_terse t JOIN read_careful c USING (note_id)""", "read_terse", "read_careful")
def _(d: Data):
    """Both readings of every note; one pass over the texts reads them, so that nothing is left to join."""
    from cohortsieve.functions.rules import CAREFUL, TERSE
    from cohortsieve.operators.extract import extract_side_by_side
    return extract_side_by_side(d.table("note"), "note_text", {"terse": TERSE, "careful": CAREFUL}) \
        .select("note_id", F.col("terse_her2_status").alias("terse_her2"), F.col("careful_her2_status").alias("careful_her2"))


@query("j11_latest_review", """
SELECT s.person_id, s.trial_id, s.eligible, r.decision FROM prescreen s
LEFT JOIN latest_review r ON r.person_id = s.person_id AND r.trial_id = s.trial_id""", "prescreen", "latest_review")
def _(d: Data):
    return effective(d.prescreen, d.table("review")).select("person_id", "trial_id", "eligible", "decision")


@query("w1_row_number", """
SELECT person_id, measurement_source_value, max_by(measurement_id, (measurement_datetime, measurement_id)) AS measurement_id
FROM measurement GROUP BY person_id, measurement_source_value""", "measurement")
def _(d: Data):
    return latest_by(d.table("measurement"), ["person_id", "measurement_source_value"],
                     [F.desc("measurement_datetime"), F.desc("measurement_id")]) \
        .select("person_id", "measurement_source_value", "measurement_id")


@query("w2_top_n", """
SELECT person_id, age_at_dx_years FROM demographics ORDER BY age_at_dx_years DESC NULLS LAST, person_id LIMIT 10""",
       "demographics")
def _(d: Data):
    return d.demographics.select("person_id", "age_at_dx_years") \
        .orderBy(F.desc_nulls_last("age_at_dx_years"), "person_id").limit(10)


@query("w3_set_operations", """
SELECT DISTINCT person_id FROM (SELECT person_id FROM profile UNION ALL SELECT person_id FROM therapy)""",
       "profile", "therapy")
def _(d: Data):
    return d.profile.select("person_id").unionByName(d.therapy.select("person_id")).distinct()
