"""Typed attributes out of free text, and what was gained by reading it."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortsieve.functions import rules as R
from cohortsieve.functions.statuses import parse_response
from cohortsieve.vocabulary import NEGATIVE, POSITIVE


def _with_statements(df: DataFrame, text: str, markers) -> DataFrame:
    lines = df.withColumn("_said_lines", R.marker_lines(F.col(text)))
    return lines.withColumns({f"_said_{m}": R.statements(F.col("_said_lines"), m) for m in markers})


def _drop_statements(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith("_said_")))


def extract(df: DataFrame, text: str, rules: R.RuleSet = R.CAREFUL) -> DataFrame:
    """Add one status column per marker, read from ``text`` by ``rules``.

    Map-side only: each whole text is scanned once for the lines that name a marker, and patterns and
    rules then work on those few lines.
    """
    said = _with_statements(df, text, rules.ladders)
    return _drop_statements(said.withColumns(rules.statuses(lambda m: F.col(f"_said_{m}"))))


def extract_each(df: DataFrame, text: str, configs: dict[str, R.RuleSet]) -> DataFrame:
    """One row per input row and configuration, from a single pass over the texts."""
    markers = sorted({m for r in configs.values() for m in r.ladders})
    said = _with_statements(df, text, markers)
    answers = [
        F.struct(F.lit(name).alias("config"),
                 *(c.alias(m) for m, c in r.statuses(lambda m: F.col(f"_said_{m}")).items()))
        for name, r in sorted(configs.items())
    ]
    return _drop_statements(said.withColumn("_answer", F.explode(F.array(*answers)))) \
        .select("*", "_answer.*").drop("_answer")


def extract_side_by_side(df: DataFrame, text: str, configs: dict[str, R.RuleSet]) -> DataFrame:
    """One row per input row, with a column ``<config>_<marker>`` for each answer, from a single pass over the texts."""
    said = _with_statements(df, text, sorted({m for r in configs.values() for m in r.ladders}))
    answers = {f"{name}_{m}": c for name, r in configs.items() for m, c in r.statuses(lambda m: F.col(f"_said_{m}")).items()}
    return _drop_statements(said.withColumns(answers))


def extract_with(df: DataFrame, text: str, fn: Callable[[pd.Series], pd.Series], schema: str,
                 partitions: int | None = None) -> DataFrame:
    """Add the fields of ``schema`` as read by a user's model.

    ``fn`` takes a batch of whole texts and returns one JSON answer per text; it runs in Arrow
    batches on the executors. Answers may be fenced or wrapped. ``partitions`` spreads a scan of few,
    large files over the cores before the model runs.
    """
    if partitions:
        df = df.repartition(partitions)
    ask = F.pandas_udf(fn, "string")
    answered = df.withColumn("_raw", ask(F.col(text)))
    return answered.withColumn("_answer", parse_response(F.col("_raw"), schema)) \
        .select("*", "_answer.*").drop("_raw", "_answer")


def one_per_entity(df: DataFrame, entity: str, order: str) -> DataFrame:
    """The row with the largest ``order`` per entity.

    Spark limits each group before the shuffle as well as after it, so an entity that holds a large
    share of all rows sends one row per map task.
    """
    newest_first = Window.partitionBy(entity).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn("_n", F.row_number().over(newest_first)).filter("_n = 1").drop("_n")


def recovery(gap: DataFrame, extracted: DataFrame, key: str, status: str) -> DataFrame:
    """Of the entities in ``gap``: how many, how many were read, how many with a definite status."""
    read = extracted.select(key, F.col(status).alias("_status"), F.lit(1).alias("_read"))
    definite = F.col("_status").isin(POSITIVE, NEGATIVE)
    return gap.select(key).distinct().join(read, key, "left").agg(
        F.count(F.lit(1)).alias("gap_entities"),
        F.count("_read").alias("recovered"),
        F.count(F.when(definite, 1)).alias("with_definite_status"),
    )


def agreement(a: DataFrame, b: DataFrame, key: str, col: str) -> DataFrame:
    """Entities in both frames, how many agree on ``col``, and the share in percent."""
    both = a.select(key, F.col(col).alias("_a")).join(b.select(key, F.col(col).alias("_b")), key)
    same: Column = F.when(F.col("_a") == F.col("_b"), 1).otherwise(0)
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(same), F.lit(0)).alias("agree"),
        F.round(100.0 * F.avg(same), 1).alias("agree_pct"),
    )
