"""Embeddings: making them, comparing them, and finding each entity's nearest others."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from cohortsieve.functions.vectors import cosine, unit
from cohortsieve.operators.ranking import rank_within
from cohortsieve.operators.search import BLOCK_ROWS, DECIMALS, block_search, bucket_search, limit_per, projected_buckets
from cohortsieve.session import cut_lineage

# Most copied vectors that are broadcast, and parts a copied vector's rows are spread over beyond that.
COPIES_TO_BROADCAST = 1000
SALTS = 32


def embed_with(df: DataFrame, text: str, fn: Callable[[pd.Series], pd.Series], out: str = "embedding",
               partitions: int | None = None) -> DataFrame:
    """Add a vector per row from a user's model, in Arrow batches on the executors.

    ``fn`` takes a batch of whole texts and returns one list of floats each.
    """
    if partitions:
        df = df.repartition(partitions)
    return df.withColumn(out, F.pandas_udf(fn, "array<float>")(F.col(text)))


def hash_embed(df: DataFrame, text: str, dim: int = 64, out: str = "embedding") -> DataFrame:
    """Hashed word counts scaled to length one: an embedding that needs no model."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    words = df.withColumn("_words", F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    counted = HashingTF(numFeatures=dim, inputCol="_words", outputCol="_counts").transform(words)
    scaled = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(counted)
    return scaled.withColumn(out, vector_to_array("_unit", "float32")).drop("_words", "_counts", "_unit")


def similar_to(df: DataFrame, id_col: str, vec_col: str, query_id, k: int = 3) -> DataFrame:
    """The ``k`` rows most like one given row, which is left out. The query is one vector."""
    found = df.filter(F.col(id_col) == query_id).select(vec_col).limit(1).collect()
    if not found:
        raise ValueError(f"no row with {id_col} = {query_id!r}")
    query = F.lit(np.asarray(found[0][0], dtype="float64").tolist())
    return df.filter(F.col(id_col) != query_id) \
        .select(id_col, F.round(cosine(F.col(vec_col), query), DECIMALS).alias("similarity")) \
        .orderBy(F.desc("similarity"), id_col).limit(k)


def comparable(vec: Column) -> Column:
    """Whether a vector can be compared: it is not NULL and every element is a finite number."""
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf"))), F.lit(False))


def incomparable(df: DataFrame, vec_col: str) -> DataFrame:
    """The rows that ``similar_all`` sets aside, to be reported beside its result."""
    return df.filter(~comparable(F.col(vec_col)))


def _indexed(vectors: DataFrame, keep: int, numbered: bool = False) -> tuple[DataFrame, Row]:
    """The distinct vectors as a written table, and one row: how many there are, their dimension, and how many have many copies.

    A vector is named by its smallest id, or ``numbered`` where an id may have several vectors.
    """
    distinct = _distinct_vectors(vectors, keep)
    distinct = cut_lineage(distinct.withColumn("rep", F.monotonically_increasing_id()) if numbered else distinct, "distinct")
    size = distinct.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.size("ids") == keep, 1)).alias("copied"),
        F.max(F.size("unit")).alias("dim"), F.min(F.size("unit")).alias("low")).first()
    if size["n"] and size["low"] != size["dim"]:
        raise ValueError("vectors differ in dimension")
    return distinct, size


def similar_all(df: DataFrame, id_col: str, vec_col: str, k: int = 5, report: dict | None = None, queries: Column | None = None) -> DataFrame:
    """For every row, or those that ``queries`` names, its ``k`` most similar others: (id, neighbour_id, similarity, rank). Exact.

    Equal vectors are searched once, group against group (``search.block_search``); each meeting hands on no more than ``k + 1`` rows per vector. No
    candidate that could count is ever left out. ``report`` gets how many pairs of vectors met. Rows whose vector is NULL or holds NULL, NaN or an infinity
    neither ask nor answer; ``incomparable`` lists them.
    """
    vectors = df.filter(comparable(F.col(vec_col))) \
        .select(F.col(id_col).alias("id"), unit(F.col(vec_col)).alias("unit"))
    distinct, size = _indexed(vectors, k + 1)
    if not size["n"]:
        return df.select(id_col, F.col(id_col).alias("neighbour_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("rank")).limit(0)
    asking = None if queries is None else df.filter(queries & comparable(F.col(vec_col))).select(F.col(id_col).alias("id"), unit(F.col(vec_col)).alias("unit"))
    if asking is not None:
        found = distinct.join(asking.select("unit").distinct().withColumn("asks", F.lit(True)), "unit", "left")
        distinct = cut_lineage(found.withColumn("asks", F.coalesce("asks", F.lit(False))), "asking")
    pairs, met = block_search(distinct, k + 1, size["n"], size["dim"], asks=None if asking is None else F.col("asks"))
    if report is not None:
        report.update(met=met.met, pairs=met.pairs, share=met.share)

    best_first = Window.partitionBy("rep").orderBy(F.desc("similarity"), "other")
    nearest = pairs.withColumn("_n", F.row_number().over(best_first)).filter(F.col("_n") <= k + 1)
    members = distinct.select(F.col("rep").alias("other"), "ids")
    by_id = Window.partitionBy("rep").orderBy(F.desc("similarity"), "neighbour_id")
    shortlist = (
        nearest.join(members, "other")
        .select("rep", "similarity", F.explode("ids").alias("neighbour_id"))
        .withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= k + 1)
        .groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("_n", "neighbour_id", "similarity"))).alias("near"))
    )
    others = F.slice(F.filter("near", lambda x: x["neighbour_id"] != F.col("id")), 1, k)
    every = _for_every_id(vectors, distinct, shortlist, k + 1, size["copied"])
    if asking is not None:
        every = every.join(asking.select("id").distinct(), "id", "left_semi")
    return every.select("id", F.posexplode(others).alias("_pos", "_x")).select(
        F.col("id").alias(id_col), F.col("_x.neighbour_id").alias("neighbour_id"),
        F.col("_x.similarity").alias("similarity"), (F.col("_pos") + 1).alias("rank"))


def _for_every_id(vectors: DataFrame, distinct: DataFrame, shortlist: DataFrame, keep: int,
                  n_copied: int) -> DataFrame:
    """(id, near) for every row, copies included.

    A vector with fewer than ``keep`` ids lists all of its rows already. Only vectors with more copies
    are looked up among all rows: broadcast if they are few, else joined under a salt, because one of
    them may stand for a large share of the rows.
    """
    answered = distinct.select("unit", "ids", "rep").join(shortlist, "rep")
    few = answered.filter(F.size("ids") < keep).select(F.explode("ids").alias("id"), "near")
    if n_copied == 0:
        return few
    many = answered.filter(F.size("ids") == keep).select("unit", "near")
    if n_copied <= COPIES_TO_BROADCAST:
        found = vectors.join(F.broadcast(many), "unit")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
        found = vectors.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")) \
            .join(many.select("*", salts), ["unit", "_salt"])
    return few.unionByName(found.select("id", "near"))


def _distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector with its ``keep`` smallest ids; the smallest names it.

    The row limit per vector is applied before the shuffle too, so copies of one vector do not pile
    up in a task. More ids than that can never be among anyone's nearest.
    """
    smallest = Window.partitionBy("unit").orderBy("id")
    return vectors.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= keep) \
        .groupBy("unit").agg(F.sort_array(F.collect_list("id")).alias("ids")) \
        .select("unit", "ids", F.element_at("ids", 1).alias("rep"))


def similar_entities(df: DataFrame, entity: str, vec_col: str, k: int = 5) -> DataFrame:
    """For every entity, a set of vectors, its ``k`` most similar others: (entity, neighbour_id, similarity, rank). Exact.

    Two entities are as similar as the most similar pair of their vectors; an entity's own vectors are left out. It is enough to
    find the ``k + 1`` most similar entities of every distinct vector: whoever comes before one of an entity's nearest on the list of the vector that
    found it is at least as similar to the entity. Rows whose vector cannot be compared neither ask nor answer.
    """
    vectors = df.filter(comparable(F.col(vec_col)) & F.col(entity).isNotNull()) \
        .select(F.col(entity).alias("id"), unit(F.col(vec_col)).alias("unit")).distinct()
    distinct, size = _indexed(vectors, k + 1, numbered=True)
    pairs, _ = block_search(distinct, k + 1, size["n"], size["dim"] or 1, per_entity=True) if size["n"] else (None, None)
    if pairs is None:
        return df.select(entity, F.col(entity).alias("neighbour_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("rank")).limit(0)
    best = pairs.groupBy("rep", "other").agg(F.max("similarity").alias("similarity"))
    best = limit_per(best, ["rep"], [F.desc("similarity"), F.asc("other")], k + 1)
    shortlist = best.groupBy("rep").agg(F.collect_list(F.struct("other", "similarity")).alias("near"))
    each = _for_every_id(vectors, distinct, shortlist, k + 1, size["copied"]).select("id", F.inline("near")).filter("id <> other")
    pairs = each.groupBy("id", "other").agg(F.max("similarity").alias("similarity"))
    numbered = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other")))
    return numbered.filter(F.col("rank") <= k).select(F.col("id").alias(entity), F.col("other").alias("neighbour_id"), "similarity", "rank")


def similar_candidates(df: DataFrame, id_col: str, vec_col: str, queries: Column, k: int = 5, tables: int = 24, bits: int = 8) -> DataFrame:
    """The ``k`` most similar others of the rows that ``queries`` names, among rows that share a random-projection bucket with them. Approximate.

    Every row is indexed, in ``tables`` tables. A bucket that holds many rows is cut into slices that queries meet one by one, so no
    task holds a bucket. More tables raise the recall, more bits lower the work; ``recall_at`` measures it against all rows.
    """
    # A row without an id can be nobody's neighbour.
    vectors = df.filter(comparable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("rep"), unit(F.col(vec_col)).alias("unit"))
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("unit")).alias("dim")).first()
    slices = max(1, -(-size["n"] // (BLOCK_ROWS << bits)) * 4)
    # Several buckets of a table are handed to a task together, up to about four blocks.
    chunks = F.pmod("bucket", F.lit(max(1, -(-size["n"] // (slices * 4 * BLOCK_ROWS))))).alias("chunk")
    hashed = projected_buckets(vectors, size["dim"] or 1, tables, bits)
    asking = df.filter(queries & comparable(F.col(vec_col))).select(F.col(id_col).alias("rep"), unit(F.col(vec_col)).alias("unit"))
    asks = projected_buckets(asking, size["dim"] or 1, tables, bits).select(F.col("rep").alias("asker"), F.col("unit").alias("asked"), "table", "bucket", chunks,
                       F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    held = hashed.select("*", chunks).withColumn("slice", F.pmod(F.xxhash64("rep"), F.lit(slices)).cast("int"))
    # The same pair may meet in several tables; it counts once.
    scored = bucket_search(asks, held, ["table", "chunk", "slice"], k).groupBy("asker", "rep").agg(F.max("similarity").alias("similarity"))
    numbered = scored.withColumn("rank", F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("similarity"), "rep")))
    return numbered.filter(F.col("rank") <= k).select(F.col("asker").alias(id_col), F.col("rep").alias("neighbour_id"), "similarity", "rank")


def recall_at(found: DataFrame, exact: DataFrame, id_col: str) -> DataFrame:
    """One row: how many of the exact neighbours were found, or others as similar as the last of them, and the share."""
    last = exact.groupBy(id_col).agg(F.min("similarity").alias("_last"), F.count(F.lit(1)).alias("_n"))
    hits = found.join(last.select(id_col, "_last"), id_col).filter(F.col("similarity") >= F.col("_last")).groupBy(id_col).agg(F.count(F.lit(1)).alias("_hit"))
    both = last.join(hits, id_col, "left")
    return both.agg(F.sum(F.least("_n", F.coalesce("_hit", F.lit(0)))).alias("found"), F.sum("_n").alias("wanted")) \
        .withColumn("recall", F.round(F.try_divide(F.col("found").cast("double"), F.col("wanted")), 4))


def expand_cohort(neighbours: DataFrame, id_col: str, eligible: DataFrame) -> DataFrame:
    """Entities near the eligible ones that are not eligible themselves.

    ``neighbours`` is a ``similar_all`` table; result: candidate, how many eligible entities it is
    near to, and the closest similarity.
    """
    known = eligible.select(F.col(id_col)).distinct()
    near = neighbours.join(known, id_col, "left_semi")
    fresh = near.join(known.select(F.col(id_col).alias("neighbour_id")), "neighbour_id", "left_anti")
    return fresh.groupBy(F.col("neighbour_id").alias("candidate_id")).agg(
        F.count(F.lit(1)).alias("near_eligible"), F.max("similarity").alias("best_similarity"))


# Default weights and scales of the contact order.
WEIGHTS = {"recency": 0.4, "source": 0.3, "stage": 0.2, "age": 0.1}
STAGE_RANK = {"Stage I": 1, "Stage IIA": 2, "Stage IIB": 3, "Stage IIIA": 4, "Stage IIIB": 5, "Stage IV": 6}


def priority_features(as_of: str) -> dict[str, Column]:
    """What a contact order goes by, each between 0 and 1; a missing feature counts 0."""
    days = F.date_diff(F.lit(as_of).cast("date"), F.col("last_seen"))
    features = {
        "recency": F.lit(1.0) / (F.lit(1.0) + F.greatest(days, F.lit(0)) / F.lit(365.0)),
        "source": F.when(F.col("biomarker_source") == "nlp", 0.0).otherwise(1.0),
        "stage": F.coalesce(*(F.when(F.col("ajcc_stage") == s, F.lit(r / 6.0)) for s, r in STAGE_RANK.items())),
        "age": F.greatest(F.lit(0.0), F.lit(1.0) - F.col("age_at_dx_years") / F.lit(100.0)),
    }
    return {name: F.coalesce(value, F.lit(0.0)) for name, value in features.items()}


def priority_score(as_of: str, weights: dict[str, float] = WEIGHTS) -> Column:
    """Weighted sum of features."""
    features = priority_features(as_of)
    return sum((F.lit(w) * features[f] for f, w in weights.items()), F.lit(0.0))


def prioritise(long: DataFrame, last_seen: DataFrame, as_of: str,
               weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Contact order of eligible patients per trial. Ranks only those the rules already passed."""
    scored = long.filter("eligible").join(last_seen, "person_id", "left") \
        .select("trial_id", "person_id", F.round(priority_score(as_of, weights), 6).alias("score"))
    return rank_within(scored, ["trial_id"], [F.desc("score"), F.asc("person_id")], "priority")
