"""Tables and views that results are published to."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_table(df: DataFrame, target: str, mode: str = "overwrite", *, partition_by: tuple = (),
                bucket_by: tuple[str, int] | None = None) -> None:
    """Write to a path (contains "/") or a catalog table, replacing data and schema by default.

    ``bucket_by=("person_id", n)`` on a catalog table lets every later join or aggregation on that
    key start without a shuffle.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        if bucket_by:
            raise ValueError("buckets need a catalog table")
        writer.parquet(target)
        return
    if bucket_by:
        key, n = bucket_by
        writer = writer.bucketBy(n, key).sortBy(key)
    writer.format("parquet").option("overwriteSchema", "true").saveAsTable(target)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Publish ``df`` under a view name and return the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def describe_columns(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach comments to columns; they travel in the schema and into saved tables."""
    unknown = sorted(set(comments) - set(df.columns))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.withColumns(
        {c: F.col(c).alias(c, metadata={"comment": text}) for c, text in comments.items()}
    )


def comment_on_table(spark: SparkSession, table: str, text: str) -> None:
    quoted = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")


def refresh(name: str, builders: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]],
            save: Callable[[str, DataFrame], DataFrame],
            _done: dict[str, DataFrame] | None = None, _open: tuple[str, ...] = ()) -> DataFrame:
    """Rebuild table ``name`` after everything it is built from.

    ``builders`` maps a name to (inputs, builder); ``save`` stores a frame and hands back the stored
    one, so each table is computed once however many others read it.
    """
    done = {} if _done is None else _done
    if name in _open:
        raise ValueError("circular inputs: " + " <- ".join((*_open, name)))
    if name not in done:
        inputs, build = builders[name]
        frames = [refresh(i, builders, save, done, (*_open, name)) for i in inputs]
        done[name] = save(name, build(*frames))
    return done[name]


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """What the files under ``paths`` are: their number and a sum over names, sizes and times; their content is not read."""
    if not paths:
        return "none"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


@dataclass(frozen=True)
class Builder:
    """How a result is built: from other results, from files, and by which version of its rules."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    files: tuple[str, ...] = ()
    version: str = ""


def refresh_stale(spark: SparkSession, name: str, builders: dict[str, Builder], root: str) -> tuple[DataFrame, list[str]]:
    """Table ``name`` below ``root``, and the names of the results that had to be rebuilt for it.

    A result is stale if its files, its version or a result it is built from have changed since it was written. What each was built
    from is kept beside it, and is written after the rows, so that a refresh that fails builds that result again.
    """
    keys: dict[str, str] = {}
    rebuilt: list[str] = []

    def known(result: str) -> str | None:
        try:
            return spark.read.text(f"{root}/{result}.built-from").first()[0]
        except AnalysisException:
            return None

    def visit(result: str, path: tuple[str, ...]) -> None:
        if result in path:
            raise ValueError("circular inputs: " + " <- ".join((*path, result)))
        if result in keys:
            return
        b = builders[result]
        for i in b.inputs:
            visit(i, (*path, result))
        parts = [fingerprint(spark, list(b.files)), b.version, *(keys[i] for i in b.inputs)]
        keys[result] = hashlib.sha256("|".join(parts).encode()).hexdigest()
        if known(result) != keys[result]:
            frames = [spark.read.parquet(f"{root}/{i}") for i in b.inputs]
            write_table(b.build(*frames), f"{root}/{result}")
            spark.createDataFrame([(keys[result],)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{result}.built-from")
            rebuilt.append(result)

    visit(name, ())
    return spark.read.parquet(f"{root}/{name}"), rebuilt
