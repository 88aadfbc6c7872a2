"""Screening every entity against every trial, with criteria kept as data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Trials up to this number travel inside the plan as one literal; beyond it they are joined.
TRIALS_IN_PLAN = 64
# Trials per cell and slices of patients when they are joined.
TRIALS_PER_CELL = 64
PATIENT_SLICES = 1024


@dataclass(frozen=True)
class Criterion:
    """One requirement: when it passes, how its failure reads and how a pass is summed up.

    ``passes`` may be NULL, which means the entity has no value to compare; that never qualifies.
    """

    name: str
    passes: Callable[[], Column]
    failure: Callable[[], Column]
    summary: Callable[[], Column] | None = None


def _unless_open(requirement: str, test: Column) -> Column:
    return F.col(requirement).isNull() | test


def equals(name: str, requirement: str, value: str, label: str) -> Criterion:
    return Criterion(
        name,
        passes=lambda: _unless_open(requirement, F.col(value) == F.col(requirement)),
        # Wording of reasons, here and below.
        failure=lambda: F.concat(F.lit(f"Excluded: {label} is "), F.coalesce(F.col(value), F.lit("Unknown")),
                                 F.lit(" (need "), F.col(requirement), F.lit(")")),
        summary=lambda: F.when(F.col(requirement).isNotNull(), F.concat(F.lit(f"{label} "), F.col(value))),
    )


MENOPAUSAL = Criterion(
    "menopausal",
    passes=lambda: _unless_open("req_menopausal", F.col("menopausal_status") == F.col("req_menopausal")),
    failure=lambda: F.concat(
        F.lit("Excluded: "), F.coalesce(F.col("menopausal_status"), F.lit("menopausal status unknown")),
        F.lit(" (need "), F.col("req_menopausal"), F.lit(")")),
    summary=lambda: F.when(F.col("req_menopausal").isNotNull(), F.col("menopausal_status")),
)
AGE = Criterion(
    "age",
    passes=lambda: F.col("age_at_dx_years").between(F.col("age_min"), F.col("age_max")),
    failure=lambda: F.concat(F.lit("Excluded: age "), F.col("age_at_dx_years").cast("string"),
                             F.lit(" outside "), F.col("age_min").cast("string"),
                             F.lit(" to "), F.col("age_max").cast("string")),
    summary=lambda: F.concat(F.lit("age "), F.col("age_at_dx_years").cast("string")),
)
PRIOR_ANTI_HER2 = Criterion(
    "prior_anti_her2",
    passes=lambda: _unless_open("req_no_prior_anti_her2",
                                F.col("req_no_prior_anti_her2") & ~F.col("prior_anti_her2")),
    failure=lambda: F.lit("Excluded: prior anti-HER2 therapy"),
)
SEX = Criterion(
    "sex",
    passes=lambda: _unless_open("req_sex", F.upper("gender") == F.upper("req_sex")),
    failure=lambda: F.concat(F.lit("Excluded: sex "), F.col("gender"),
                             F.lit(" (need "), F.col("req_sex"), F.lit(")")),
)
STAGE = Criterion(
    "stage",
    passes=lambda: _unless_open("req_stage", F.array_contains("req_stage", F.col("ajcc_stage"))),
    failure=lambda: F.concat(F.lit("Excluded: "), F.coalesce(F.col("ajcc_stage"), F.lit("stage unknown")),
                             F.lit(" (need "), F.array_join("req_stage", " or "), F.lit(")")),
    summary=lambda: F.when(F.col("req_stage").isNotNull(), F.col("ajcc_stage")),
)

# In the order failures are reported in.
STANDARD = [
    equals("her2", "req_her2", "her2_status", "HER2"),
    equals("er", "req_er", "er_status", "ER"),
    equals("pr", "req_pr", "pr_status", "PR"),
    MENOPAUSAL, AGE, PRIOR_ANTI_HER2, SEX,
]
WITH_STAGE = [*STANDARD[:4], STAGE, *STANDARD[4:]]

SCREEN_COLUMNS = [
    "person_id", "trial_id", "trial_name", "trial_status", "gender", "age_at_dx_years", "her2_status",
    "er_status", "pr_status", "menopausal_status", "ajcc_stage", "prior_anti_her2",
    "biomarker_source", "min_ecog", "eligibility_text", "eligible", "reason",
]


def patient_frame(profile: DataFrame, demographics: DataFrame, therapy: DataFrame) -> DataFrame:
    """One comparable row per person; no therapy row means no prior therapy."""
    return compared(demographics.join(profile, "person_id"), therapy)


def compared(people: DataFrame, therapy: DataFrame) -> DataFrame:
    """The columns trials compare, from persons who have demographics and statuses on one row."""
    return (
        people.join(therapy.select("person_id", "had_anti_her2_therapy"), "person_id", "left")
        .select("person_id", F.col("gender_source_value").alias("gender"), "age_at_dx_years",
                "her2_status", "er_status", "pr_status", "menopausal_status", "ajcc_stage",
                "biomarker_source",
                F.coalesce("had_anti_her2_therapy", F.lit(False)).alias("prior_anti_her2"))
    )


def with_trials(patients: DataFrame, criteria: DataFrame) -> DataFrame:
    """Each patient once per trial, without a cross join.

    A catalogue of a checked, small size becomes a literal array that every row unfolds in place: no
    join, no shuffle. A larger one is joined on a grid: trials are cut into cells, patients into
    slices, and the two meet on the (cell, slice) key, so every task gets a bounded share of both.
    """
    trials = criteria.withColumnRenamed("status", "trial_status")
    rows = trials.limit(TRIALS_IN_PLAN + 1).collect()
    if not rows:
        return patients.join(trials, F.lit(False))
    if len(rows) <= TRIALS_IN_PLAN:
        # Each value as a literal of its column's type: the same value that a join would bring.
        catalogue = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in trials.schema.fields]) for r in rows])
        return patients.select("*", F.inline(catalogue))
    return _grid_join(patients, trials, trials.count())


def _grid_join(patients: DataFrame, trials: DataFrame, n_trials: int) -> DataFrame:
    cells = -(-n_trials // TRIALS_PER_CELL)
    left = patients.withColumns({
        "_slice": F.pmod(F.xxhash64("person_id"), F.lit(PATIENT_SLICES)),
        "_cell": F.explode(F.sequence(F.lit(0), F.lit(cells - 1))),
    })
    right = trials.withColumns({
        "_cell": F.pmod(F.xxhash64("trial_id"), F.lit(cells)).cast("int"),
        "_slice": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PATIENT_SLICES - 1).cast("bigint"))),
    })
    return left.join(right.hint("shuffle_hash"), ["_cell", "_slice"]).drop("_cell", "_slice")


def screen(patients: DataFrame, criteria: DataFrame, spec: list[Criterion] | None = None, *,
           flags: bool = False) -> DataFrame:
    """One row per patient and trial with ``eligible`` and a ``reason``.

    A requirement that is NULL is open; a patient value that is NULL fails a set one. The reason is
    the first failing criterion in the order of ``spec``, or a summary of what was met. ``flags``
    keeps the three-valued ``ok_<criterion>`` columns and the name of the first failure.
    """
    if spec is None:
        spec = WITH_STAGE if "req_stage" in criteria.columns else STANDARD
    judged = with_trials(patients, criteria).withColumns({f"ok_{c.name}": c.passes() for c in spec})
    failed = F.coalesce(*(F.when(~F.coalesce(F.col(f"ok_{c.name}"), F.lit(False)), c.name) for c in spec))
    judged = judged.withColumn("first_failure", failed) \
        .withColumn("eligible", F.col("first_failure").isNull())
    met = F.concat_ws(", ", *(c.summary() for c in spec if c.summary))
    reason = F.when(F.col("eligible"), F.concat(F.lit("Eligible: "), met, F.lit(" ("),
                                                F.col("biomarker_source"), F.lit(")")))
    reason = reduce(lambda acc, c: acc.when(F.col("first_failure") == c.name, c.failure()), spec, reason)
    extra = [f"ok_{c.name}" for c in spec] + ["first_failure"] if flags else []
    return judged.withColumn("reason", reason).select(*SCREEN_COLUMNS, *extra)


def screen_subset(patients: DataFrame, criteria: DataFrame, people: DataFrame | None = None,
                  trials: list[str] | None = None) -> DataFrame:
    """Screen chosen people against chosen trials; both filters come before the screening."""
    if people is not None:
        patients = patients.join(people.select("person_id").distinct(), "person_id", "left_semi")
    if trials is not None:
        criteria = criteria.filter(F.col("trial_id").isin(trials))
    return screen(patients, criteria)


def widen(long: DataFrame, entity: str, key: str, values: list[str], cols: list[str],
          carry: list[str]) -> DataFrame:
    """One row per entity: ``cols`` once per key value, as ``trial_<value>_<col>``, and ``carry``."""
    return long.groupBy(entity).agg(
        *(F.max(c).alias(c) for c in carry),
        *(F.max(F.when(F.col(key) == val, F.col(c))).alias(f"trial_{val.lower()}_{c}")
          for val in values for c in cols),
    )
