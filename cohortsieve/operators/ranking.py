"""Ranks over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortsieve.session import cut_lineage


def rank_within(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """1, 2, 3, ... per group in ``order`` (which must be unique within the group).

    A plain window would pull a whole group into one task. Here rows are range-partitioned by group
    and order, numbered inside each partition, and moved up by the rows that precede the partition,
    so a group may span any number of tasks. The partitioned rows are written once, which also keeps
    the partition numbers the same for both uses.
    """
    spread = df.repartitionByRange(*(F.col(g) for g in group), *order) \
        .withColumn("_part", F.spark_partition_id())
    spread = cut_lineage(spread, "rank")
    local = spread.withColumn("_local", F.row_number().over(
        Window.partitionBy(*group, "_part").orderBy(*order)))
    # One row per group and partition it reaches into: at most groups + partitions rows in all.
    sizes = spread.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, [*group, "_part"]) \
        .withColumn(out, (F.col("_before") + F.col("_local")).cast("bigint")) \
        .drop("_part", "_local", "_before")
