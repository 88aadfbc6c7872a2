"""Named queries over a data folder, each with SQL that checks it where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortsieve.plans.checks import with_views
from cohortsieve.plans.cohort_build import CohortBuild
from cohortsieve.sources.fixtures import FixtureSource


class Data(CohortBuild):
    """The build over one data folder, plus its plain tables."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(FixtureSource(spark, folder))
        self.folder, self.raw, self.table = folder, self.source.raw, self.source.table

    @cached_property
    def omop(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in
                ("person", "condition_occurrence", "measurement", "observation", "drug_exposure", "note")}


QUERIES: dict[str, Callable[[Data], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    """Register a query; ``views`` are the shared definitions its check SQL reads."""
    def register(fn: Callable[[Data], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = with_views(sql, *views)
        return fn
    return register


def text(name: str) -> Column:
    """A date or a three-valued flag as text, so that every engine shows it alike."""
    return F.col(name).cast("string").alias(name)
