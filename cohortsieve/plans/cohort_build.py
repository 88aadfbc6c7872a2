"""The cohort build: source tables to a screened cohort with a reason per row."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from cohortsieve import vocabulary as v
from cohortsieve.functions import rules as R
from cohortsieve.operators import evaluate, extract, features, fuse, report, screen
from cohortsieve.sources.tables import criteria

STATUS_COLUMNS = list(v.MARKERS)


class CohortBuild:
    """Every frame of the build, declared lazily over one source.

    Facts, notes and persons all shuffle once, by ``person_id``, and every later join reuses that.
    Texts never shuffle: only what was read from them does.
    """

    def __init__(self, source, rules: R.RuleSet = R.CAREFUL, trials: DataFrame | None = None):
        self.source, self.rules, self.spark = source, rules, source.spark
        self.criteria = criteria(self.spark) if trials is None else trials

    @cached_property
    def profile(self) -> DataFrame:
        return features.biomarker_profile(self.source.table("measurement"))

    @cached_property
    def therapy(self) -> DataFrame:
        return features.prior_therapy(self.source.table("drug_exposure"))

    @cached_property
    def demographics(self) -> DataFrame:
        return features.demographics(self.source.table("person"), self.source.table("condition_occurrence"),
                                     self.source.table("observation"))

    @cached_property
    def reports(self) -> DataFrame:
        return self.source.table("note").filter(F.col("note_source_value") == v.PATHOLOGY_REPORT)

    @cached_property
    def extracted(self) -> DataFrame:
        """One row per person with a report: statuses of the latest one."""
        read = extract.extract(self.reports, "note_text", self.rules) \
            .select("note_id", "person_id", *STATUS_COLUMNS)
        return extract.one_per_entity(read, "person_id", "note_id") \
            .withColumn("biomarker_source", F.lit(v.FROM_NOTES))

    @cached_property
    def unified(self) -> DataFrame:
        return fuse.fuse(self.profile, self.extracted, "person_id", STATUS_COLUMNS)

    @cached_property
    def patients(self) -> DataFrame:
        """The same rows as ``patient_frame(unified, ...)``, without shuffling the unified profile."""
        people = fuse.fuse_onto(self.demographics, self.profile, self.extracted, "person_id", STATUS_COLUMNS)
        return screen.compared(people, self.therapy)

    @cached_property
    def prescreen(self) -> DataFrame:
        return screen.screen(self.patients, self.criteria)

    @cached_property
    def flagged(self) -> DataFrame:
        return screen.screen(self.patients, self.criteria, flags=True)

    @cached_property
    def wide(self) -> DataFrame:
        return screen.widen(
            self.prescreen, "person_id", "trial_id", ["A", "B", "C"], ["eligible", "reason"],
            ["gender", "age_at_dx_years", "her2_status", "er_status", "pr_status", "menopausal_status",
             "ajcc_stage", "prior_anti_her2", "biomarker_source"])

    @cached_property
    def timeline(self) -> DataFrame:
        return report.timeline(self.source.table("measurement"))

    @cached_property
    def last_seen(self) -> DataFrame:
        """The date of each person's last measurement."""
        return self.timeline.groupBy("person_id").agg(F.max("measurement_date").alias("last_seen"))

    @cached_property
    def goldset(self) -> DataFrame:
        return evaluate.goldset(self.source.table("note"), self.profile)
