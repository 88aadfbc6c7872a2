"""The training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

A stage is (name, function); the function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``. Defined cases are those of the operators: a NULL text is an empty one and fails the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortsieve.llm import decontaminate, jaccard_join, line_dedup, quality_rules, suffix_match
from cohortsieve.llm.pieces import broadcast_model
from cohortsieve.llm.texts import free_name, table
from cohortsieve.session import cut_lineage

#: Near duplicates share this percentage of their five-word shingles, or more.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one, exactly or nearly; those without a word left are left out."""
    return line_dedup.drop_lines(docs).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id; rows with the same doc_id stay together."""
    found = jaccard_join.with_components(docs, NEAR_PERCENT, NEAR_WORDS)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and number of tokens."""
    encoded = suffix_match.encode(docs, broadcast_model(spark))
    return encoded.withColumn(free_name(encoded, "n_tokens"), F.size(encoded.columns[-1]).cast("long"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("decontamination", benchmark_free), ("sentencepiece", tokens)]

#: SQL cannot fit the quality model or encode texts; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written to the shared folder before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs, "stage-" + name.replace(" ", "-"))
    return docs
