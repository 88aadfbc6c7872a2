"""Who may see which rows and values, and which tables a result came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortsieve.operators.profiling import IDENTIFIERS, occurs

FULL_ACCESS = ("admin", "coordinator")


def protected_ids(person: DataFrame, flag: str = "is_high_profile") -> DataFrame:
    """Persons to hide; none where the source has no such flag."""
    hidden = F.col(flag) if flag in person.columns else F.lit(False)
    return person.filter(hidden).select("person_id")


def row_filter(df: DataFrame, protected: DataFrame, role: str, key: str = "person_id") -> DataFrame:
    """All rows for roles with full access, else those of unprotected entities."""
    return df if role in FULL_ACCESS else df.join(protected.select(key), key, "left_anti")


def redact(df: DataFrame, col: str) -> DataFrame:
    """Identifiers inside a text replaced by their kind. Texts without one are passed on as they are."""
    for kind, pattern in IDENTIFIERS.items():
        text = F.col(col)
        df = df.withColumn(col, F.when(occurs(text, kind), F.regexp_replace(text, pattern, f"[{kind}]"))
                           .otherwise(text))
    return df


def _hash(df: DataFrame, col: str, key: str | None) -> DataFrame:
    if not key:
        raise ValueError("hashing needs a secret key: an unkeyed hash of a small number is undone by counting")
    inner = F.sha2(F.concat(F.lit(key + ":"), F.col(col).cast("string")), 256)
    return df.withColumn(col, F.sha2(F.concat(F.lit(key + ":"), inner), 256))


def _null(df: DataFrame, col: str, key: str | None) -> DataFrame:
    return df.withColumn(col, F.lit(None).cast(df.schema[col].dataType))


MASKS = {"hash": _hash, "null": _null, "redact": lambda df, col, key: redact(df, col)}


def mask(df: DataFrame, strategies: dict[str, str], role: str, key: str | None = None) -> DataFrame:
    """Values as a role may see them: ``hash`` (keyed by ``key``), ``null`` or ``redact`` (identifiers inside text)."""
    if role not in FULL_ACCESS:
        for col, strategy in strategies.items():
            df = MASKS[strategy](df, col, key)
    return df


# Which inputs each result is made from.
EDGES = {
    "silver_biomarker_profile": ("measurement",),
    "silver_prior_therapy": ("drug_exposure",),
    "silver_demographics": ("person", "condition_occurrence", "observation"),
    "silver_nlp_biomarkers": ("note",),
    "gold_unified_biomarker_profile": ("silver_biomarker_profile", "silver_nlp_biomarkers"),
    "gold_trial_prescreen": ("gold_unified_biomarker_profile", "silver_demographics",
                             "silver_prior_therapy", "silver_trial_criteria"),
    "gold_trial_prescreen_wide": ("gold_trial_prescreen",),
    "gold_patient_measurements": ("measurement",),
}


def lineage(spark: SparkSession, edges: dict[str, tuple[str, ...]] = EDGES) -> DataFrame:
    return spark.createDataFrame([(out, i) for out, ins in edges.items() for i in ins],
                                 "output string, input string")


def file_lineage(df: DataFrame, output: str) -> DataFrame:
    """The files a frame is read from."""
    return df.sparkSession.createDataFrame([(output, f) for f in sorted(df.inputFiles())],
                                           "output string, input string")
