"""Human decisions next to the screened result, which they never change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

REVIEW_COLUMNS = ("review_id bigint, person_id bigint, trial_id string, decision string, "
                  "reasoning string, reviewer string, reviewed_at timestamp")
KEYS = ["person_id", "trial_id"]


def newest_first() -> list[Column]:
    return [F.desc("reviewed_at"), F.desc("review_id")]


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``; each key is cut to one row before the shuffle as well."""
    numbered = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter("_n = 1").drop("_n")


def record_reviews(log: DataFrame | None, new: DataFrame) -> DataFrame:
    """The log with new decisions merged in: one row per person and trial, the latest wins."""
    everything = new if log is None else log.unionByName(new, allowMissingColumns=True)
    return latest_by(everything, KEYS, newest_first())


def append_reviews(new: DataFrame, path: str) -> None:
    """Add decisions to an append-only log; readers take ``latest_by``."""
    new.write.mode("append").parquet(path)


def effective(long: DataFrame, reviews: DataFrame) -> DataFrame:
    """Model result, human decision where there is one, and the eligibility that holds.

    Only ``approved`` and ``rejected`` overrule the model; any other word leaves its result.

    A person's decisions, at most one per trial, are folded into a map and joined by person alone.
    The long table, much the larger one, so keeps the partitioning by person it was built with.
    """
    answer = F.struct("trial_id", F.struct("decision", "reasoning"))
    # A decision that names no trial holds for none.
    decided = latest_by(reviews.filter(F.col("trial_id").isNotNull()), KEYS, newest_first()).groupBy("person_id") \
        .agg(F.map_from_entries(F.collect_list(answer)).alias("_decided"))
    found = F.try_element_at("_decided", F.col("trial_id"))
    return long.join(decided, "person_id", "left").withColumn("_found", found) \
        .select(*long.columns, "_found.decision", "_found.reasoning") \
        .withColumn("effective_eligible", F.when(F.col("decision") == "approved", True)
                    .when(F.col("decision") == "rejected", False).otherwise(F.col("eligible")))


def review_summary(long: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per trial: eligible patients reviewed or not, and how often human and model agree."""
    judged = effective(long, reviews)
    reviewed, eligible = F.col("decision").isNotNull(), F.col("eligible")
    agrees = (F.col("decision") == "approved") == eligible
    return judged.groupBy("trial_id").agg(
        F.count(F.when(eligible & reviewed, 1)).alias("eligible_reviewed"),
        F.count(F.when(eligible & ~reviewed, 1)).alias("eligible_not_reviewed"),
        F.count(F.when(F.col("decision") == "approved", 1)).alias("approved"),
        F.count(F.when(F.col("decision") == "rejected", 1)).alias("rejected"),
        F.count(F.when(agrees, 1)).alias("agrees_with_model"),
    )
