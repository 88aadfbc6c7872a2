"""Sources, sinks, profiling and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortsieve import vocabulary as v
from cohortsieve.operators import profiling as P
from cohortsieve.operators import govern, screen
from cohortsieve.plans.registry import Data, query, text
from cohortsieve.session import new_folder
from cohortsieve.sources import schemas, sinks
from cohortsieve.sources.tables import Source


@query("s1_source_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(d: Data):
    return Source(d.spark, path=d.folder, suffix=".parquet").table("customer") \
        .select("c_custkey", "c_name", "c_mktsegment")


@query("s2_source_views", """
SELECT gender_source_value, count(*) AS persons, count(DISTINCT note_id) AS notes
FROM person LEFT JOIN note ON note.person_id = person.person_id GROUP BY gender_source_value""",
       "person", "note")
def _(d: Data):
    d.source.register_views(("person", "note"))
    persons, notes = d.spark.table("person"), d.spark.table("note")
    return persons.join(notes.select("person_id", "note_id"), "person_id", "left") \
        .groupBy("gender_source_value") \
        .agg(F.count(F.lit(1)).alias("persons"), F.count_distinct("note_id").alias("notes"))


@query("s3_repointed_source", """
SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def _(d: Data):
    other = Source(d.spark, path=d.folder, suffix=".parquet")
    return other.table("supplier").join(other.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .groupBy("n_name").agg(F.count(F.lit(1)).alias("suppliers"))


@query("s4_criteria_rows", """
SELECT trial_id, trial_name, trial_status, req_her2, req_er, req_pr, req_menopausal,
  CAST(req_no_prior_anti_her2 AS VARCHAR) AS req_no_prior_anti_her2,
  CAST(min_ecog AS VARCHAR) AS min_ecog, count(*) AS in_age_and_sex
FROM trials JOIN demographics ON age_at_dx_years BETWEEN age_min AND age_max
  AND upper(gender_source_value) = upper(req_sex)
GROUP BY ALL""", "trials", "demographics")
def _(d: Data):
    people = d.demographics.select("person_id", "age_at_dx_years", F.col("gender_source_value").alias("gender"))
    fits = screen.AGE.passes() & screen.SEX.passes()
    return screen.with_trials(people, d.criteria).filter(fits).groupBy(
        "trial_id", "trial_name", "trial_status", "req_her2", "req_er", "req_pr", "req_menopausal",
        text("req_no_prior_anti_her2"), text("min_ecog")).agg(F.count(F.lit(1)).alias("in_age_and_sex"))


@query("s5_write_table", "SELECT * FROM profile", "profile")
def _(d: Data):
    path = new_folder(d.spark, "silver_biomarker_profile")
    sinks.write_table(d.profile, path)
    return d.spark.read.parquet(path)


@query("s6_conform", """
SELECT measurement_id, person_id, measurement_source_value, value_source_value,
  CAST(measurement_date AS VARCHAR) AS measurement_date, CAST(NULL AS VARCHAR) AS measurement_time,
  23 AS n_columns FROM measurement""", "measurement")
def _(d: Data):
    full = schemas.conform(d.table("measurement"), schemas.omop("measurement"))
    return full.select("measurement_id", "person_id", "measurement_source_value", "value_source_value",
                       text("measurement_date"), "measurement_time",
                       F.lit(len(full.columns)).alias("n_columns"))


@query("s6_null_violations", " UNION ALL ".join(
    f"SELECT '{c} is set' AS expectation, count({v}) AS passed, count(*) - count({v}) AS violations FROM person" for c, v in (
        ("person_id", "person_id"), ("gender_concept_id", "NULL"), ("year_of_birth", "year_of_birth"),
        ("race_concept_id", "NULL"), ("ethnicity_concept_id", "NULL"), ("is_high_profile", "is_high_profile"))), "person")
def _(d: Data):
    """Which columns of the declared layout must have a value, and how many rows of the source have none."""
    layout = schemas.omop("person")
    return P.expectation_report(schemas.conform(d.table("person"), layout), schemas.required(layout))


@query("s7_conformed_schemas", " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, {n} AS columns, count(*) AS rows FROM {t}" for t, n in (
        # How many columns the declared layouts have.
        ("person", 20), ("condition_occurrence", 17), ("measurement", 23), ("observation", 21), ("drug_exposure", 23), ("note", 16))),
       "person", "condition_occurrence", "measurement", "observation", "drug_exposure", "note")
def _(d: Data):
    """Rows and columns of every source table once it has its declared layout."""
    counts = [
        schemas.conform(df, schemas.omop(name)).agg(
            F.lit(name).alias("tbl"), F.lit(len(schemas.omop(name))).alias("columns"),
            F.count(F.lit(1)).alias("rows"))
        for name, df in d.omop.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("s8_published_view", """
SELECT person_id, trial_id, CAST(eligible AS VARCHAR) AS eligible FROM prescreen""", "prescreen")
def _(d: Data):
    return sinks.register_view(d.prescreen, "gold_trial_prescreen").select("person_id", "trial_id", text("eligible"))


@query("s9_column_comments", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS comment, count({c}) AS filled FROM prescreen" for c, t in (
        ("person_id", "One patient."), ("trial_id", "Trial code."), ("eligible", "Meets every criterion."),
        ("reason", "Why the patient is or is not eligible."), ("biomarker_source", "Facts or notes."))), "prescreen")
def _(d: Data):
    """Column comments next to how many rows have a value there."""
    comments = {
        "person_id": "One patient.", "trial_id": "Trial code.", "eligible": "Meets every criterion.",
        "reason": "Why the patient is or is not eligible.", "biomarker_source": "Facts or notes.",
    }
    described = sinks.describe_columns(d.prescreen, comments)
    noted = {f.name: f.metadata.get("comment") for f in described.schema.fields if "comment" in f.metadata}
    filled = described.agg(*(F.count(c).alias(c) for c in noted))
    return filled.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("comment"), F.col(c).alias("filled"))
        for c, t in noted.items()))))


@query("s10_refresh", """
SELECT biomarker_source, count(*) AS entities FROM unified GROUP BY biomarker_source""", "unified")
def _(d: Data):
    from cohortsieve.operators import features, fuse
    root = new_folder(d.spark, "refresh")

    def save(name, df):
        sinks.write_table(df, f"{root}/{name}")
        return d.spark.read.parquet(f"{root}/{name}")

    builders = {
        "profile": ((), lambda: features.biomarker_profile(d.table("measurement"))),
        "extracted": ((), lambda: d.extracted),
        "unified": (("profile", "extracted"), lambda p, x: fuse.fuse(p, x, "person_id", list(v.MARKERS))),
        "counts": (("unified",), fuse.source_counts),
    }
    return sinks.refresh("counts", builders, save)


@query("s10_stale_refresh", """
SELECT biomarker_source, count(*) AS entities, 'extracted,unified,counts' AS rebuilt FROM unified GROUP BY biomarker_source""", "unified")
def _(d: Data):
    """Built with the terse rules, then refreshed with the careful ones: the profile, which does not hang on them, stays."""
    from cohortsieve.functions import rules as R
    from cohortsieve.operators import features, fuse
    from cohortsieve.plans.cohort_build import CohortBuild
    root, facts, notes = new_folder(d.spark, "stale"), (d.source.path("lineitem"), d.source.path("orders")), (d.source.path("documents"),)

    def builders(rules):
        return {
            "profile": sinks.Builder(lambda: features.biomarker_profile(d.table("measurement")), files=facts),
            "extracted": sinks.Builder(lambda: CohortBuild(d.source, rules).extracted, files=notes, version=rules.name),
            "unified": sinks.Builder(lambda p, x: fuse.fuse(p, x, "person_id", list(v.MARKERS)), inputs=("profile", "extracted")),
            "counts": sinks.Builder(fuse.source_counts, inputs=("unified",)),
        }

    sinks.refresh_stale(d.spark, "counts", builders(R.TERSE), root)
    counts, rebuilt = sinks.refresh_stale(d.spark, "counts", builders(R.CAREFUL), root)
    return counts.withColumn("rebuilt", F.lit(",".join(rebuilt)))


@query("s11_rewrite_table", "SELECT person_id, had_anti_her2_therapy FROM therapy", "therapy")
def _(d: Data):
    """A second write with another schema replaces rows and columns of the first."""
    path = new_folder(d.spark, "silver_prior_therapy")
    sinks.write_table(d.therapy, path)
    sinks.write_table(d.therapy.select("person_id", "had_anti_her2_therapy"), path)
    return d.spark.read.parquet(path)


@query("p1_table_counts", """
SELECT 'person' AS tbl, count(*) AS n FROM person
UNION ALL SELECT 'condition_occurrence', count(*) FROM condition_occurrence
UNION ALL SELECT 'measurement', count(*) FROM measurement
UNION ALL SELECT 'observation', count(*) FROM observation
UNION ALL SELECT 'drug_exposure', count(*) FROM drug_exposure
UNION ALL SELECT 'note', count(*) FROM note""",
       "person", "condition_occurrence", "measurement", "observation", "drug_exposure", "note")
def _(d: Data):
    return P.table_counts(d.omop)


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) - count({c}) AS nulls, "
        f"round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct, "
        f"count(DISTINCT {c}) AS distinct_values FROM {table}"
        for c, t in columns.items())


@query("p2_profile_columns", _profile_sql("measurement", {
    "measurement_id": "bigint", "person_id": "bigint", "measurement_source_value": "string",
    "value_source_value": "string", "measurement_date": "date", "measurement_datetime": "timestamp_ntz",
    "value_as_number": "double", "unit_source_value": "string"}), "measurement")
def _(d: Data):
    return P.profile_columns(d.table("measurement"))


@query("p3_sample_rows", """
SELECT note_id, person_id, note_source_value, note_text FROM note ORDER BY note_id LIMIT 2""", "note")
def _(d: Data):
    return P.sample_rows(d.table("note"), ["note_id"], 2)


@query("p4_value_counts", """
SELECT observation_source_value, value_source_value, count(*) AS n, count(DISTINCT person_id) AS entities
FROM observation GROUP BY ALL""", "observation")
def _(d: Data):
    return P.value_counts(d.table("observation"), "observation_source_value", "value_source_value", "person_id")


@query("p5_distribution", """
SELECT value_source_value, count(*) AS n,
  round(100.0 * count(*) / (SELECT count(*) FROM observation WHERE observation_source_value = 'AJCC stage'), 1) AS pct
FROM observation WHERE observation_source_value = 'AJCC stage' GROUP BY value_source_value""", "observation")
def _(d: Data):
    staged = d.table("observation").filter(F.col("observation_source_value") == v.OBSERVATIONS["ajcc_stage"])
    return P.distribution(staged, "value_source_value")


def expectations():
    return {
        "person_id_not_null": F.col("person_id").isNotNull(),
        "age_plausible": F.col("age_at_dx_years").between(18, 110),
    }


@query("p6_expectations", """
SELECT 'person_id_not_null' AS expectation, count(*) FILTER (WHERE person_id IS NOT NULL) AS passed,
  count(*) FILTER (WHERE person_id IS NULL) AS violations FROM demographics
UNION ALL
SELECT 'age_plausible', count(*) FILTER (WHERE age_at_dx_years BETWEEN 18 AND 110),
  count(*) - count(*) FILTER (WHERE age_at_dx_years BETWEEN 18 AND 110) FROM demographics""", "demographics")
def _(d: Data):
    return P.expectation_report(d.demographics, expectations())


@query("p6_expect_drop", """
SELECT person_id, age_at_dx_years FROM demographics
WHERE person_id IS NOT NULL AND age_at_dx_years BETWEEN 30 AND 80""", "demographics")
def _(d: Data):
    rules = {**expectations(), "age_in_study": F.col("age_at_dx_years").between(30, 80)}
    return P.expect(d.demographics, rules, "drop").select("person_id", "age_at_dx_years")


@query("p7_grain_violations", """
SELECT person_id, measurement_source_value, count(*) AS n FROM measurement
GROUP BY ALL HAVING count(*) > 1""", "measurement")
def _(d: Data):
    return P.grain_violations(d.table("measurement"), ["person_id", "measurement_source_value"])


@query("p8_run_checks", """
SELECT 'persons' AS "check", count(*) AS observed, 1 AS at_least, CAST(NULL AS BIGINT) AS at_most, count(*) >= 1 AS passed FROM person
UNION ALL SELECT 'persons with a repeated id', count(*) - count(DISTINCT person_id), NULL, 0,
  count(*) - count(DISTINCT person_id) <= 0 FROM person
UNION ALL SELECT 'equivocal reports', count(*), 1, NULL, count(*) >= 1 FROM note
  WHERE note_source_value = 'PATHOLOGY_REPORT' AND note_text LIKE '%equivocal by IHC%'
UNION ALL SELECT 'persons without diagnosis', count(*), 0, 0, count(*) BETWEEN 0 AND 0 FROM person
  WHERE person_id NOT IN (SELECT person_id FROM demographics)""", "person", "note", "demographics")
def _(d: Data):
    person, note = d.table("person"), d.table("note")
    n = F.count(F.lit(1)).alias("n")
    return P.run_checks([
        P.Check("persons", person.agg(n), low=1),
        P.Check("persons with a repeated id", person.agg(F.count(F.lit(1)) - F.count_distinct("person_id")), high=0),
        P.Check("equivocal reports", note.filter(
            (F.col("note_source_value") == v.PATHOLOGY_REPORT)
            & F.col("note_text").contains("equivocal by IHC")).agg(n), low=1),
        P.Check("persons without diagnosis",
                person.join(d.demographics.select("person_id"), "person_id", "left_anti").agg(n), low=0, high=0),
    ])


@query("p9_readable", """
SELECT 'person' AS tbl, count(*) > 0 AS has_rows FROM person
UNION ALL SELECT 'condition_occurrence', count(*) > 0 FROM condition_occurrence
UNION ALL SELECT 'measurement', count(*) > 0 FROM measurement
UNION ALL SELECT 'observation', count(*) > 0 FROM observation
UNION ALL SELECT 'drug_exposure', count(*) > 0 FROM drug_exposure
UNION ALL SELECT 'note', count(*) > 0 FROM note""",
       "person", "condition_occurrence", "measurement", "observation", "drug_exposure", "note")
def _(d: Data):
    return P.readable(d.omop)


@query("p10_population_summary", """
SELECT 'silver_biomarker_profile' AS tbl, count(*) AS "rows", count(her2_status) AS populated FROM profile
UNION ALL SELECT 'silver_prior_therapy', count(*), count(*) FILTER (WHERE had_anti_her2_therapy) FROM therapy
UNION ALL SELECT 'silver_demographics', count(*), count(*) FILTER (WHERE menopausal_status = 'Postmenopausal')
FROM demographics""", "profile", "therapy", "demographics")
def _(d: Data):
    return P.population_summary({
        "silver_biomarker_profile": (d.profile, F.col("her2_status").isNotNull()),
        "silver_prior_therapy": (d.therapy, F.col("had_anti_her2_therapy")),
        "silver_demographics": (d.demographics, F.col("menopausal_status") == v.POSTMENOPAUSAL),
    })


@query("p11_vector_profile", """
SELECT count(*) AS n, min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim,
  count(*) - count(DISTINCT embedding) AS repeated FROM embeddings""")
def _(d: Data):
    return P.vector_profile(d.raw("embeddings"), "embedding")


def _scan_sql(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS kind, count(*) FILTER (WHERE regexp_matches({c}, '{p}')) AS matches, "
        f"round(100.0 * count(*) FILTER (WHERE regexp_matches({c}, '{p}')) / count({c}), 2) AS pct FROM {table}"
        for c in columns for kind, p in P.IDENTIFIERS.items())


@query("p12_identifier_scan", _scan_sql("documents", ["text", "lang", "source"]))
def _(d: Data):
    return P.identifier_scan(d.raw("documents"))


@query("p13_side_by_side", """
SELECT p.person_id, her2_status, er_status, pr_status, note_id, note_text
FROM profile p JOIN note n ON n.person_id = p.person_id WHERE note_source_value = 'PATHOLOGY_REPORT'
ORDER BY p.person_id, note_id LIMIT 5""", "profile", "note")
def _(d: Data):
    return P.side_by_side(d.profile, d.reports, "person_id", list(v.MARKERS), "note_text",
                          ["person_id", "note_id"], 5)


@query("c1_row_filter", """
SELECT person_id, trial_id, reason FROM prescreen
WHERE person_id NOT IN (SELECT person_id FROM person WHERE is_high_profile)""", "prescreen", "person")
def _(d: Data):
    return govern.row_filter(d.prescreen, govern.protected_ids(d.table("person")), "analyst") \
        .select("person_id", "trial_id", "reason")


@query("c2_mask", """
SELECT sha256('example-key:' || sha256('example-key:' || CAST(person_id AS VARCHAR))) AS person_key, note_id, CAST(NULL AS VARCHAR) AS note_source_value,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(note_text,
    '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[email]', 'g'),
    '\\b[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\\b', '[phone]', 'g'),
    '\\b[0-9]{3}-[0-9]{2}-[0-9]{4}\\b', '[ssn]', 'g'),
    '\\b[0-9]{4}-[0-9]{2}-[0-9]{2}\\b|\\b[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\\b', '[date]', 'g'),
    '\\bMRN[-: ]*[0-9]+', '[record_number]', 'g') AS note_text
FROM note""", "note")
def _(d: Data):
    return govern.mask(d.table("note"), {"person_id": "hash", "note_source_value": "null", "note_text": "redact"},
                       "analyst", key="example-key").withColumnRenamed("person_id", "person_key")
