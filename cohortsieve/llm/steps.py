"""Written steps of long jobs: freeing what is done, and reading a few rows of a large table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortsieve.session import cut_lineage

#: The largest bit map that is shipped; a map has eight bits or more for each id, or two at this size.
MOST_BITS = 1 << 24
#: Spark's setting to delete the shuffle files of a query that has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for shuffle partitions that are hashed in a join instead of sorted, if all of one side are no larger.
HASHED_PARTITION = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def written(df: DataFrame, purpose: str, settings: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared folder, under Spark ``settings``, and read back; the shuffle files that it took are deleted once all rows are written."""
    conf = df.sparkSession.conf
    wanted = {_CLEANUP: "true"} | (settings or {})
    before = {name: conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            conf.set(name, value)
        return cut_lineage(df, purpose)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def release(*written: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for these; nothing that reads them may run afterwards."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._cut_folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def maybe_of(key: str, ids: DataFrame) -> Column:
    """Whether a ``key`` (a long) may be one of ``ids``, which has a column of that name: a bit map of hashes, at most MOST_BITS long; NULL is none."""
    bits = max(min(1 << max(8 * ids.count() - 1, 0).bit_length(), MOST_BITS), 32)
    # Hashed, as numbers that Spark deals out per partition have few different remainders.
    r = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(bits)))
    found = ids.filter(F.col(key).isNotNull()).groupBy(F.shiftright(r, 5).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (r % 32).cast("int"))).alias("bits")).collect()
    words = ["0"] * (bits // 32)
    for row in found:
        words[row["w"]] = str(row["bits"])
    # One literal: Spark folds the cast of the joined text.
    table = F.split(F.lit(",".join(words)), ",").cast("array<bigint>")
    return F.call_function("shiftright", table[F.shiftright(r, 5).cast("int")], (r % 32).cast("int")).bitwiseAND(F.lit(1)) == 1


def rows_of(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` (a long) is one of ``ids`` (a written table of distinct longs of that name).

    Up to a counted number of ids, a bit map rules out most other rows before anything is shuffled; beyond it the
    rows are shuffled. The semi join decides either way.
    """
    if 2 * ids.count() <= MOST_BITS:
        df = df.filter(maybe_of(key, ids))
    return df.join(ids, key, "left_semi")
