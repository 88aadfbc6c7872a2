"""Declared schemas of the six clinical source tables, and conforming a frame to a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

# Table layouts of the public OMOP Common Data Model as the source tables declare them.
OMOP: dict[str, str] = {
    "person": (
        "person_id bigint not null, gender_concept_id int not null, year_of_birth int not null, "
        "month_of_birth int, day_of_birth int, birth_datetime timestamp, "
        "race_concept_id int not null, ethnicity_concept_id int not null, location_id bigint, "
        "provider_id bigint, care_site_id bigint, person_source_value string, "
        "gender_source_value string, gender_source_concept_id int, race_source_value string, "
        "race_source_concept_id int, ethnicity_source_value string, "
        "ethnicity_source_concept_id int, birth_date date, is_high_profile boolean not null"
    ),
    "condition_occurrence": (
        "condition_occurrence_id bigint not null, person_id bigint not null, "
        "condition_concept_id int not null, condition_start_date date not null, "
        "condition_start_datetime timestamp, condition_end_date date, "
        "condition_end_datetime timestamp, condition_type_concept_id int not null, "
        "condition_status_concept_id int, stop_reason string, provider_id bigint, "
        "visit_occurrence_id bigint, visit_detail_id bigint, condition_source_value string, "
        "condition_source_concept_id int, condition_status_source_value string, "
        "condition_source_name string"
    ),
    "measurement": (
        "measurement_id bigint not null, person_id bigint, measurement_concept_id int, "
        "measurement_date date, measurement_datetime timestamp, measurement_time string, "
        "measurement_type_concept_id int, operator_concept_id int, value_as_number float, "
        "value_as_concept_id int, unit_concept_id int, range_low float, range_high float, "
        "provider_id bigint, visit_occurrence_id bigint, visit_detail_id bigint, "
        "measurement_source_value string, measurement_source_concept_id int, "
        "unit_source_value string, unit_source_concept_id int, value_source_value string, "
        "measurement_event_id int, meas_event_field_concept_id int"
    ),
    "observation": (
        "observation_id bigint not null, person_id bigint, observation_concept_id int, "
        "observation_date date, observation_datetime timestamp, observation_type_concept_id int, "
        "value_as_number float, value_as_string string, value_as_concept_id int, "
        "qualifier_concept_id int, unit_concept_id int, provider_id bigint, "
        "visit_occurrence_id bigint, visit_detail_id bigint, observation_source_value string, "
        "observation_source_concept_id int, unit_source_value string, "
        "qualifier_source_value string, value_source_value string, observation_event_id int, "
        "obs_event_field_concept_id int"
    ),
    "drug_exposure": (
        "drug_exposure_id bigint not null, person_id bigint, drug_concept_id int, "
        "drug_exposure_start_date date, drug_exposure_start_datetime timestamp, "
        "drug_exposure_end_date date, drug_exposure_end_datetime timestamp, "
        "verbatim_end_date date, drug_type_concept_id int, stop_reason string, refills int, "
        "quantity float, days_supply int, sig string, route_concept_id int, lot_number string, "
        "provider_id bigint, visit_occurrence_id bigint, visit_detail_id bigint, "
        "drug_source_value string, drug_source_concept_id int, route_source_value string, "
        "dose_unit_source_value string"
    ),
    "note": (
        "note_id bigint not null, person_id bigint, note_date date, note_datetime timestamp, "
        "note_type_concept_id int, note_class_concept_id int, note_title string, "
        "note_text string, encoding_concept_id int, language_concept_id int, provider_id bigint, "
        "visit_occurrence_id bigint, visit_detail_id bigint, note_source_value string, "
        "note_event_id bigint, note_event_field_concept_id bigint"
    ),
}


def omop(name: str) -> StructType:
    """Declared schema of a source table."""
    return StructType.fromDDL(OMOP[name])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types; absent ones become NULL, others go."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def required(schema: StructType) -> dict[str, Column]:
    """An expectation per NOT NULL column: it has a value (see ``profiling.expect``)."""
    return {f"{f.name} is set": F.col(f.name).isNotNull() for f in schema.fields if not f.nullable}


def conform_checked(df: DataFrame, schema: StructType, action: str = "fail") -> DataFrame:
    """``conform``, with the schema's NOT NULL kept: rows that break it are dropped (``drop``), stop the job (``fail``) or are marked by a column that names the NULLs (``warn``)."""
    rows, missing = conform(df, schema), F.array_compact(F.array(*[
        F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]))
    if action == "warn":
        return rows.withColumn("null_columns", missing)
    if action == "drop":
        return rows.filter(F.size(missing) == 0)
    if action != "fail":
        raise ValueError(f"unknown action {action!r}")
    first = next((f.name for f in schema.fields if not f.nullable), None)
    if first is None:
        return rows
    stop = F.raise_error(F.concat(F.lit("NULL in NOT NULL column: "), F.array_join(missing, ", ")))
    return rows.withColumn(first, F.when(F.size(missing) > 0, stop.cast(schema[first].dataType)).otherwise(F.col(first)))
