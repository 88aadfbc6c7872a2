"""Where an entity's evidence lives: in facts, in notes, in both or in neither."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LABELS = {"both": "both", "left": "structured-only", "right": "notes-only", "neither": "neither"}


def presence(entities: DataFrame, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per entity with ``in_left`` and ``in_right``.

    The three key columns are stacked and grouped once, so there is a single shuffle of keys with
    map-side combining, however often an entity occurs on either side.
    """
    def mark(df: DataFrame, known: int, in_left: int, in_right: int) -> DataFrame:
        return df.select(F.col(key), F.lit(known).alias("_known"), F.lit(in_left).alias("_left"),
                         F.lit(in_right).alias("_right"))

    stacked = mark(entities, 1, 0, 0).unionByName(mark(left, 0, 1, 0)) \
        .unionByName(mark(right, 0, 0, 1))
    return (
        stacked.groupBy(key)
        .agg(F.max("_known").alias("_known"), F.max("_left").alias("_left"),
             F.max("_right").alias("_right"))
        .filter("_known = 1 and " + key + " is not null")
        .select(key, (F.col("_left") == 1).alias("in_left"), (F.col("_right") == 1).alias("in_right"))
    )


def coverage(entities: DataFrame, left: DataFrame, right: DataFrame, key: str,
             labels: dict[str, str] = LABELS) -> DataFrame:
    """Every entity with its evidence class."""
    in_left, in_right = F.col("in_left"), F.col("in_right")
    return presence(entities, left, right, key).select(
        key,
        F.when(in_left & in_right, labels["both"]).when(in_left, labels["left"])
        .when(in_right, labels["right"]).otherwise(labels["neither"]).alias("evidence"),
    )


def only_in(right: DataFrame, left: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``right`` that ``left`` does not have. NULL keys belong to neither."""
    return right.select(key).filter(F.col(key).isNotNull()).distinct() \
        .join(left.select(key).distinct(), key, "left_anti")


def gap_share(classified: DataFrame, label: str) -> DataFrame:
    """Members of one class, all entities, and the share in whole percent."""
    n = F.count(F.when(F.col("evidence") == label, 1))
    return classified.agg(n.alias("gap"), F.count(F.lit(1)).alias("total")).withColumn(
        "gap_pct", F.round(F.try_divide(100.0 * F.col("gap"), F.col("total")), 0)
    )


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """``key NOT IN (SELECT other_key FROM other)`` with SQL's NULL rules, as an ordinary anti join.

    A NULL in ``other`` leaves no rows; a NULL ``key`` never qualifies; an empty ``other`` keeps all
    rows. Written this way the join shuffles both sides and needs no side to fit in memory.
    """
    # Distinct first: it combines map-side, so a key with most of the rows is one row in the join.
    there = other.select(F.col(other_key or key).alias("_there")).distinct()
    rows, known = F.count(F.lit(1)), F.count("_there")
    kind = there.agg(F.when(rows == 0, "empty").when(known < rows, "holds null").otherwise("plain")).scalar()
    unmatched = df.join(there, F.col(key) == F.col("_there"), "left_anti")
    return unmatched.filter((kind == "empty") | ((kind == "plain") & F.col(key).isNotNull()))
