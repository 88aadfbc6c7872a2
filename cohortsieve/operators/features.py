"""Per-entity features out of long fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortsieve import vocabulary as v


def pivot_long(df: DataFrame, entity: str, attr: str, value: str, outputs: dict[str, str]) -> DataFrame:
    """One row per entity, one column per attribute: ``outputs`` maps attribute to column name.

    The attribute list goes to the scan as a filter, and the aggregate combines before it shuffles.
    """
    wanted = df.select(entity, attr, value).filter(F.col(attr).isin(list(outputs)))
    return wanted.groupBy(entity).agg(
        *(F.max(F.when(F.col(attr) == a, F.col(value))).alias(out) for a, out in outputs.items())
    )


def flag_any(df: DataFrame, entity: str, col: str, flags: dict[str, list[str]]) -> DataFrame:
    """Per entity: did any row carry one of the codes? Entities without such a row get ``false``."""
    return df.groupBy(entity).agg(
        *((F.max(F.when(F.col(col).isin(codes), 1).otherwise(0)) == 1).alias(f)
          for f, codes in flags.items())
    )


def first_event(df: DataFrame, entity: str, date: str, predicate: Column, out: str) -> DataFrame:
    return df.filter(predicate).groupBy(entity).agg(F.min(date).alias(out))


def max_value(df: DataFrame, entity: str, attr: str, wanted: str, value: str, out: str) -> DataFrame:
    """The largest value an entity has for one attribute."""
    return pivot_long(df, entity, attr, value, {wanted: out})


def biomarker_profile(measurement: DataFrame) -> DataFrame:
    return pivot_long(measurement, "person_id", "measurement_source_value", "value_source_value",
                      {name: col for col, name in v.MARKERS.items()})


def prior_therapy(drug_exposure: DataFrame) -> DataFrame:
    return flag_any(drug_exposure, "person_id", "drug_source_value", v.THERAPIES)


def demographics(person: DataFrame, condition: DataFrame, observation: DataFrame) -> DataFrame:
    """Diagnosed persons with age at diagnosis, menopausal status and stage.

    Every input is reduced to one row per person on the same key the joins use, so the joins reuse
    the aggregates' partitioning. Both observations come from one pass.
    """
    diagnosed = first_event(condition, "person_id", "condition_start_date",
                            F.col("condition_source_value") == v.DIAGNOSIS, "dx_date")
    observed = pivot_long(observation, "person_id", "observation_source_value", "value_source_value",
                          {name: col for col, name in v.OBSERVATIONS.items()})
    return (
        person.select("person_id", "gender_source_value", "year_of_birth")
        .join(diagnosed, "person_id")
        .join(observed, "person_id", "left")
        .select("person_id", "gender_source_value",
                (F.year("dx_date") - F.col("year_of_birth")).alias("age_at_dx_years"),
                "dx_date", *v.OBSERVATIONS)
    )


def category_counts(df: DataFrame, col: str, missing_label: str | None = None) -> DataFrame:
    """Entities per category; missing ones under ``missing_label``, or left out without a label."""
    if missing_label is None:
        rows = df.filter(F.col(col).isNotNull())
    else:
        rows = df.withColumn(col, F.coalesce(F.col(col), F.lit(missing_label)))
    return rows.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def status_matrix(profile: DataFrame, markers: dict[str, str] = v.MARKER_LABELS,
                  missing_label: str = "(missing)") -> DataFrame:
    """Marker by status counts from one scan."""
    cells = F.array(*(
        F.struct(F.lit(label).alias("marker"), F.coalesce(F.col(c), F.lit(missing_label)).alias("status"))
        for c, label in markers.items()
    ))
    return profile.select(F.inline(cells)).groupBy("marker", "status").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, width: int) -> DataFrame:
    """Counts per bin ``[k*width, (k+1)*width)``, labelled by the lower edge."""
    edge = (F.floor(F.col(col) / F.lit(width)) * F.lit(width)).cast("bigint")
    return df.filter(F.col(col).isNotNull()).groupBy(edge.alias("bin_start")) \
        .agg(F.count(F.lit(1)).alias("n"))


def top_codes(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` most frequent codes, ties by code."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), col).limit(n)
