"""Profiling and data-quality checks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

# Identifier patterns, readable by Java's and RE2's regular expressions alike.
IDENTIFIERS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\b[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "date": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b|\b[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\b",
    "record_number": r"\bMRN[-: ]*[0-9]+",
}


# The same kinds where it is enough to know that one occurs, with less backtracking.
PRESENT = {**IDENTIFIERS, "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"}

# What every identifier of a kind holds; testing for it first is far cheaper.
HOLDS_TEXT = {"email": "@", "record_number": "MRN"}
HOLDS_PATTERN = {"date": r"[0-9][-/][0-9]{1,2}[-/]"}


def occurs(text: Column, kind: str, pattern: str | None = None) -> Column:
    """Whether an identifier of this kind is in the text."""
    found = text.rlike(pattern or PRESENT[kind])
    if pattern not in (None, PRESENT.get(kind)):
        return found
    if kind in HOLDS_TEXT:
        return text.contains(HOLDS_TEXT[kind]) & found
    return text.rlike(HOLDS_PATTERN[kind]) & found if kind in HOLDS_PATTERN else found


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        for name, df in tables.items()
    ])


def profile_columns(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, nulls, null rate and distinct values of every column, from one aggregate.

    ``approximate`` counts distinct values by sketch, which shuffles no values at all.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.col(c)).alias(f"_n{i}"), distinct(F.col(c)).alias(f"_d{i}")]
    rows = F.array(*(
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
                 F.round(F.try_divide(100.0 * (F.col("_rows") - F.col(f"_n{i}")), F.col("_rows")), 2).alias("null_pct"),
                 F.col(f"_d{i}").alias("distinct_values"))
        for i, f in enumerate(df.schema.fields)
    ))
    return df.agg(*aggs).select(F.inline(rows))


def sample_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def value_counts(df: DataFrame, attr: str, value: str, entity: str) -> DataFrame:
    """Rows and entities for each value of each attribute."""
    return df.groupBy(attr, value).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(entity)).alias("entities"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows and share in percent per category. The total is a scalar, not a window over all rows."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / total, 1))


def expectation_report(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Rows that pass and rows that do not, per expectation; NULL does not pass."""
    named = list(predicates.items())
    tally = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *(F.count(F.when(p, 1)).alias(f"_p{i}") for i, (_, p) in enumerate(named)))
    rows = F.array(*(
        F.struct(F.lit(name).alias("expectation"), F.col(f"_p{i}").alias("passed"),
                 (F.col("_rows") - F.col(f"_p{i}")).alias("violations"))
        for i, (name, _) in enumerate(named)
    ))
    return tally.select(F.inline(rows))


def expect(df: DataFrame, predicates: dict[str, Column], action: str = "warn") -> DataFrame:
    """``warn`` passes every row on, ``drop`` keeps the rows that pass, ``fail`` stops on a violation."""
    if action == "warn":
        return df
    all_met = reduce(lambda a, b: a & b, (F.coalesce(p, F.lit(False)) for p in predicates.values()))
    if action == "drop":
        return df.filter(all_met)
    if action == "fail":
        stop = F.raise_error(F.lit("expectation violated: " + ", ".join(predicates)))
        return df.filter(F.when(all_met, F.lit(True)).otherwise(stop.cast("boolean")))
    raise ValueError(f"unknown action {action!r}")


def grain_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@dataclass(frozen=True)
class Check:
    """``observed`` is a one-row, one-column frame; it passes between ``low`` and ``high``."""

    name: str
    observed: DataFrame
    low: int | None = None
    high: int | None = None


def run_checks(checks: list[Check]) -> DataFrame:
    def row(c: Check) -> DataFrame:
        seen = F.col(c.observed.columns[0]).cast("bigint")
        low, high = F.lit(c.low).cast("bigint"), F.lit(c.high).cast("bigint")
        passed = F.coalesce(seen >= low, F.lit(c.low is None)) & F.coalesce(seen <= high, F.lit(c.high is None))
        return c.observed.select(F.lit(c.name).alias("check"), seen.alias("observed"),
                                 low.alias("at_least"), high.alias("at_most"), passed.alias("passed"))
    return _union([row(c) for c in checks])


def readable(tables: dict[str, DataFrame]) -> DataFrame:
    """Whether each table yields a row."""
    return _union([
        df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))
        .select(F.lit(name).alias("tbl"), "has_rows")
        for name, df in tables.items()
    ])


def population_summary(tables: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows per table, and rows where the given condition holds."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(cond, 1)).alias("populated"))
        .select(F.lit(name).alias("tbl"), "rows", "populated")
        for name, (df, cond) in tables.items()
    ])


def vector_profile(df: DataFrame, col: str) -> DataFrame:
    """Vectors, smallest and largest dimension, and how many vectors repeat another."""
    per_vector = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).withColumn("_dim", F.size(col))
    return per_vector.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.min("_dim").alias("min_dim"), F.max("_dim").alias("max_dim"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated"),
    )


def identifier_scan(df: DataFrame, patterns: dict[str, str] = PRESENT) -> DataFrame:
    """Values that look like an identifier, per text column and kind, from one pass over the rows."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    pairs = [(c, kind, p) for c in columns for kind, p in patterns.items()]
    tally = df.agg(*(F.count(c).alias(f"_v_{c}") for c in columns),
                   *(F.count(F.when(occurs(F.col(c), kind, p), 1)).alias(f"_m{i}")
                     for i, (c, kind, p) in enumerate(pairs)))
    rows = F.array(*(
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(f"_m{i}").alias("matches"),
                 F.round(F.try_divide(100.0 * F.col(f"_m{i}"), F.col(f"_v_{c}")), 2).alias("pct"))
        for i, (c, kind, _) in enumerate(pairs)
    ))
    return tally.select(F.inline(rows))


def first_rows(df: DataFrame, among: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` whose key is in ``among``, with all their columns.

    The rows are chosen on ``order`` alone; whole texts are read for those ``n`` rows only and never
    shuffle.
    """
    chosen = df.select(key, *(c for c in order if c != key)) \
        .join(among.select(key).distinct(), key, "left_semi").orderBy(*order).limit(n)
    names = list({key: 0, **dict.fromkeys(order)})
    # At most n rows. NULL order values are equal here.
    few = chosen.distinct().withColumnsRenamed({c: f"_chosen_{c}" for c in names})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_chosen_{c}")) for c in names])
    return df.join(F.broadcast(few), same, "left_semi").orderBy(*order).limit(n)


def side_by_side(structured: DataFrame, notes: DataFrame, key: str, cols: list[str], text: str,
                 order: list[str], n: int) -> DataFrame:
    """The first ``n`` notes of entities with structured values, next to those values."""
    shown = first_rows(notes.select(key, *(c for c in order if c != key), text), structured, key, order, n)
    # At most n rows again.
    return structured.select(key, *cols).join(F.broadcast(shown), key) \
        .select(key, *cols, *(c for c in order if c != key), text).orderBy(*order).limit(n)
