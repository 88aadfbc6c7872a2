"""Two sources of the same attributes made one, with a record of where each value came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortsieve.vocabulary import FROM_BOTH, FROM_FACTS, FROM_NOTES


def _side(df: DataFrame, key: str, cols: list[str], tag: str) -> DataFrame:
    return df.select(key, F.lit(True).alias(f"_{tag}"), *(F.col(c).alias(f"_{tag}_{c}") for c in cols))


def _fused(cols: list[str], three_way: bool, per_column: bool, source_col: str) -> list[Column]:
    source = F.when(F.col("_p").isNotNull(), FROM_FACTS).otherwise(FROM_NOTES)
    if three_way:
        source = F.when(F.col("_p").isNotNull() & F.col("_f").isNotNull(), FROM_BOTH).otherwise(source)
    out = [F.coalesce(F.col(f"_p_{c}"), F.col(f"_f_{c}")).alias(c) for c in cols]
    if per_column:
        out += [
            F.when(F.col(f"_p_{c}").isNotNull(), FROM_FACTS)
            .when(F.col(f"_f_{c}").isNotNull(), FROM_NOTES).alias(f"{c}_source")
            for c in cols
        ]
    return [*out, source.alias(source_col)]


def fuse(primary: DataFrame, fallback: DataFrame, key: str, cols: list[str], *,
         three_way: bool = False, per_column: bool = False,
         source_col: str = "biomarker_source") -> DataFrame:
    """Full outer join on ``key``; the primary's value wins where it has one.

    ``source_col`` says whether a primary row existed; ``three_way`` also tells entities found in
    both. ``per_column`` adds ``<col>_source`` for each single value.
    """
    both = _side(primary, key, cols, "p").join(_side(fallback, key, cols, "f"), key, "full")
    return both.select(key, *_fused(cols, three_way, per_column, source_col))


def fuse_onto(entities: DataFrame, primary: DataFrame, fallback: DataFrame, key: str, cols: list[str], *,
              three_way: bool = False, per_column: bool = False,
              source_col: str = "biomarker_source") -> DataFrame:
    """``fuse`` joined to ``entities``, which are unique by ``key``.

    The key of a full outer join belongs to neither side, so joining its result shuffles once more.
    Two left joins onto the entities say the same and keep their partitioning.
    """
    joined = entities.join(_side(primary, key, cols, "p"), key, "left") \
        .join(_side(fallback, key, cols, "f"), key, "left") \
        .filter(F.col("_p").isNotNull() | F.col("_f").isNotNull())
    return joined.select(*entities.columns, *_fused(cols, three_way, per_column, source_col))


def source_counts(df: DataFrame, source_col: str = "biomarker_source") -> DataFrame:
    return df.groupBy(source_col).agg(F.count(F.lit(1)).alias("entities"))
