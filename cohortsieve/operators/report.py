"""Summaries, lists and trusted answers over the screened cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortsieve import vocabulary as v
from cohortsieve.operators.coverage import not_in

# Conditions as SQL text.
ELIGIBLE = "eligible"
RECOVERED = f"eligible and biomarker_source = '{v.FROM_NOTES}'"


def _count(condition: str) -> Column:
    return F.count(F.when(F.expr(condition), 1))


def baseline_counts(measurement: DataFrame, condition: DataFrame, observation: DataFrame,
                    drug_exposure: DataFrame) -> DataFrame:
    """Persons eligible for trials A and B from raw facts alone.

    Having a positive ER row and a negative HER2 row is one conditional aggregate over the facts; the
    table is not joined to itself.
    """
    def has(marker: str, status: str) -> Column:
        return F.max(F.when((F.col("measurement_source_value") == v.MARKERS[marker])
                            & (F.col("value_source_value") == status), 1).otherwise(0)) == 1

    found = (
        measurement.filter(F.col("measurement_source_value").isin(
            v.MARKERS["her2_status"], v.MARKERS["er_status"]))
        .groupBy("person_id")
        .agg(has("her2_status", v.POSITIVE).alias("her2_positive"),
             has("her2_status", v.NEGATIVE).alias("her2_negative"),
             has("er_status", v.POSITIVE).alias("er_positive"))
    )
    diagnosed = condition.filter(F.col("condition_source_value") == v.DIAGNOSIS).select("person_id").distinct()
    treated = drug_exposure.filter(
        F.col("drug_source_value").isin(v.THERAPIES["had_anti_her2_therapy"])).select("person_id")
    postmenopausal = observation.filter(
        (F.col("observation_source_value") == v.OBSERVATIONS["menopausal_status"])
        & (F.col("value_source_value") == v.POSTMENOPAUSAL)).select("person_id").distinct()
    with_dx = found.join(diagnosed, "person_id", "left_semi")
    trial_a = not_in(with_dx.filter("her2_positive"), "person_id", treated)
    trial_b = with_dx.filter("er_positive and her2_negative").join(postmenopausal, "person_id", "left_semi")
    return (
        trial_a.agg(F.count(F.lit(1)).alias("eligible")).select(F.lit("A").alias("trial_id"), "eligible")
        .unionByName(trial_b.agg(F.count(F.lit(1)).alias("eligible"))
                     .select(F.lit("B").alias("trial_id"), "eligible"))
    )


def eligibility_summary(long: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Eligible patients and those found only in notes, per trial or per ``by``."""
    return long.groupBy(*(by or ["trial_id"])).agg(
        _count(ELIGIBLE).alias("eligible_patients"),
        _count(RECOVERED).alias("nlp_recovered"),
    )


def uplift(long: DataFrame) -> DataFrame:
    """Eligible without and with the notes, the gain and the gain in percent, per trial."""
    return eligibility_summary(long).select(
        "trial_id",
        (F.col("eligible_patients") - F.col("nlp_recovered")).alias("without_notes"),
        F.col("eligible_patients").alias("with_notes"),
        F.col("nlp_recovered").alias("gain"),
        F.round(F.try_divide(100.0 * F.col("nlp_recovered"),
                             F.col("eligible_patients") - F.col("nlp_recovered")), 1).alias("gain_pct"),
    )


def exclusion_summary(flagged: DataFrame) -> DataFrame:
    """Patients per trial and first failing criterion; needs ``screen(..., flags=True)``."""
    return flagged.filter("not eligible").groupBy("trial_id", "first_failure") \
        .agg(F.count(F.lit(1)).alias("patients"))


def timeline(measurement: DataFrame) -> DataFrame:
    """One row per measurement with fallbacks for date and value. Sort when reading."""
    return measurement.filter(F.col("person_id").isNotNull()).select(
        "person_id",
        F.coalesce("measurement_date", F.to_date("measurement_datetime")).alias("measurement_date"),
        F.col("measurement_source_value").alias("test_name"),
        F.coalesce("value_source_value", F.col("value_as_number").cast("string")).alias("value"),
        F.col("unit_source_value").alias("unit"),
    )


def timeline_for(timeline: DataFrame, person_id: int) -> DataFrame:
    return timeline.filter(F.col("person_id") == person_id).orderBy("measurement_date", "test_name", "value")


def eligible_list(long: DataFrame, trial_id: str, sort: str = "person_id") -> DataFrame:
    """A trial's eligible patients in a stable order."""
    return long.filter((F.col("trial_id") == trial_id) & F.col("eligible")).select(
        "person_id", "age_at_dx_years", "her2_status", "er_status", "pr_status", "menopausal_status",
        "reason", "biomarker_source",
    ).orderBy(sort, "person_id")


# Trusted questions -------------------------------------------------------------------------------

def eligible_per_trial(long: DataFrame) -> DataFrame:
    return long.filter(ELIGIBLE).groupBy("trial_id", "trial_name") \
        .agg(F.count(F.lit(1)).alias("eligible_patients"))


def eligible_by_source(long: DataFrame) -> DataFrame:
    return long.filter(ELIGIBLE).groupBy("trial_id", "biomarker_source") \
        .agg(F.count(F.lit(1)).alias("eligible_patients"))


def excluded_by_prior_therapy(long: DataFrame) -> DataFrame:
    return long.filter((F.col("trial_id") == "A") & (F.col("her2_status") == v.POSITIVE)
                       & F.col("prior_anti_her2") & ~F.col("eligible")) \
        .select("person_id", "her2_status", "prior_anti_her2", "reason").orderBy("person_id")


def eligible_with_diagnosis_date(long: DataFrame, demographics: DataFrame, trial_id: str) -> DataFrame:
    chosen = long.filter((F.col("trial_id") == trial_id) & F.col("eligible")).select("person_id", "reason")
    return chosen.join(demographics.select("person_id", "dx_date", "age_at_dx_years"), "person_id") \
        .orderBy("dx_date", "person_id")


def eligible_with_menopausal_status(long: DataFrame, trial_id: str, status: str) -> DataFrame:
    return long.filter((F.col("trial_id") == trial_id) & F.col("eligible")
                       & (F.col("menopausal_status") == status)) \
        .select("person_id", "menopausal_status", "reason").orderBy("person_id")


def distinct_patients(long: DataFrame) -> DataFrame:
    return long.agg(F.countDistinct("person_id").alias("patients"), F.count(F.lit(1)).alias("rows"))


# Named metrics -----------------------------------------------------------------------------------

# Name -> aggregate, as SQL text.
METRICS = {
    "eligible_count": f"count_if({ELIGIBLE})",
    "nlp_recovered_eligible": f"count_if({RECOVERED})",
    "screened_count": "count(1)",
}


def query_metrics(df: DataFrame, measures: list[str], dims: list[str],
                  metrics: dict[str, str] = METRICS) -> DataFrame:
    """Named measures by chosen dimensions, so that everyone counts the same way."""
    unknown = sorted(set(measures) - set(metrics))
    if unknown:
        raise ValueError(f"no such metrics: {unknown}")
    return df.groupBy(*dims).agg(*(F.expr(metrics[m]).alias(m) for m in measures))
