import numpy as np
import pandas as pd
import pytest
from helpers import rows

from cohortsieve.operators import ranking, search, similar
from pyspark.sql import functions as F

SCHEMA = "id bigint, e array<float>"


def brute(points: dict, k: int) -> list[tuple]:
    ids = sorted(points)
    mat = np.array([points[i] for i in ids], dtype="float32").astype("float64")
    mat /= np.maximum(np.linalg.norm(mat, axis=1, keepdims=True), 1e-9)
    sims = np.round(mat @ mat.T, similar.DECIMALS) + 0.0
    out = []
    for a, i in enumerate(ids):
        near = sorted((-sims[a, b], j) for b, j in enumerate(ids) if j != i)[:k]
        out += [(i, j, -s, r) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def found(spark, points, k):
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in points.items()], SCHEMA)
    return sorted((r[0], r[1], r[2] + 0.0, r[3]) for r in similar.similar_all(df, "id", "e", k).collect())


@pytest.mark.parametrize("to_broadcast", [1000, 0])
def test_many_blocks_copies_and_zero_vectors(spark, monkeypatch, to_broadcast):
    monkeypatch.setattr(search, "BLOCK_ROWS", 16)
    monkeypatch.setattr(similar, "COPIES_TO_BROADCAST", to_broadcast)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8)) * 3
    points = {i: centres[i % 6] + rng.normal(size=8) * 0.2 for i in range(150)}
    copied, zero = rng.normal(size=8), np.zeros(8)
    # A third of all rows are copies of one vector.
    points |= {i: copied for i in range(200, 280)} | {i: zero for i in range(300, 309)}
    assert found(spark, points, 4) == brute(points, 4)


def test_cells_that_cannot_matter_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    centres = np.eye(8)
    points = {i: centres[i % 8] + rng.normal(size=8) * 0.01 for i in range(400)}
    df = spark.createDataFrame([(i, p.tolist()) for i, p in points.items()], SCHEMA)
    report = {}
    got = sorted((r[0], r[1], r[2] + 0.0, r[3]) for r in similar.similar_all(df, "id", "e", 3, report).collect())
    assert got == brute(points, 3) and report["pairs"] >= 25 * 25 and report["share"] < 0.2
    assert df.count() == 400


def test_fewer_rows_than_neighbours(spark):
    points = {1: [1.0, 0.0], 2: [1.0, 0.1], 3: [0.0, 1.0]}
    assert found(spark, points, 5) == brute(points, 5)
    assert found(spark, {1: [1.0, 0.0]}, 5) == []


def test_similar_to(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0])], SCHEMA)
    assert rows(similar.similar_to(df, "id", "e", 1, 3)) == [(2, 1.0), (3, 0.0), (4, -1.0)]


def test_expand_cohort(spark):
    near = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.8), (2, 3, 0.95), (9, 8, 1.0)],
                                 "person_id int, neighbour_id int, similarity double")
    eligible = spark.createDataFrame([(1,), (2,)], "person_id int")
    assert rows(similar.expand_cohort(near, "person_id", eligible)) == [(3, 2, 0.95)]


def test_hash_embedding(spark):
    df = spark.createDataFrame([(1, "alpha beta"), (2, "beta, ALPHA"), (3, "")], "id int, t string")
    got = {r["id"]: r["embedding"] for r in similar.hash_embed(df, "t", 16).collect()}
    assert got[1] == got[2] and len(got[1]) == 16 and not any(got[3])


def test_user_embedding(spark):
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t)), 1.0])

    df = spark.createDataFrame([("abc",)], "t string")
    assert rows(similar.embed_with(df, "t", lengths).select("embedding")) == [([3.0, 1.0],)]


def test_ranks_across_partitions(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("g"),
                                  (F.col("id") % 7).alias("s"), "id")
    got = ranking.rank_within(df, ["g"], [F.desc("s"), F.asc("id")], "r").collect()
    for g in ("big", "small"):
        ordered = sorted((-r["s"], r["id"], r["r"]) for r in got if r["g"] == g)
        assert [x[2] for x in ordered] == list(range(1, len(ordered) + 1))


def test_vectors_that_cannot_be_compared_take_no_place(spark):
    rng = np.random.default_rng(3)
    points = {i: rng.normal(size=4) for i in range(12)}
    odd = [(90, [float("nan"), 1.0, 2.0, 3.0]), (91, None), (92, [1.0, None, 0.0, 0.0]), (93, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in points.items()] + odd, SCHEMA)
    got = sorted((r[0], r[1], r[2] + 0.0, r[3]) for r in similar.similar_all(df, "id", "e", 3).collect())
    assert got == brute(points, 3)
    assert sorted(r["id"] for r in similar.incomparable(df, "e").collect()) == [90, 91, 92, 93]


def test_shells_rule_out_blocks_of_one_cell(spark, monkeypatch):
    """All vectors on an arc around one pivot: only the distance to it tells them apart."""
    monkeypatch.setattr(search, "BLOCK_ROWS", 16)
    monkeypatch.setattr(search, "MAX_CELLS", 1)
    points = {i: [np.cos(i / 400), np.sin(i / 400)] for i in range(512)}
    report = {}
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in points.items()], SCHEMA)
    monkeypatch.setattr(search, "_pivots", lambda vectors, n, dim: np.array([[1.0, 0.0]]))
    got = sorted((r[0], r[1], r[2] + 0.0, r[3]) for r in similar.similar_all(df, "id", "e", 2, report).collect())
    assert got == brute(points, 2) and report["share"] < 0.2


def brute_entities(owned, k):
    """(entity, other, similarity, rank) by all pairs of vectors."""
    rows = [(e, np.asarray(p, "float32").astype("float64")) for e, p in owned]
    rows = [(e, p / max(np.linalg.norm(p), 1e-9)) for e, p in rows]
    best = {}
    for a, x in rows:
        for b, y in rows:
            if a != b:
                best[a, b] = max(best.get((a, b), -9.0), round(float(x @ y), search.DECIMALS) + 0.0)
    out = []
    for e in sorted({a for a, _ in best}):
        near = sorted((-s, b) for (a, b), s in best.items() if a == e)[:k]
        out += [(e, b, -s + 0.0, r) for r, (s, b) in enumerate(near, 1)]
    return out


@pytest.mark.parametrize("to_broadcast", [1000, 0])
def test_entities_with_several_vectors(spark, monkeypatch, to_broadcast):
    monkeypatch.setattr(search, "BLOCK_ROWS", 16)
    monkeypatch.setattr(similar, "COPIES_TO_BROADCAST", to_broadcast)
    rng = np.random.default_rng(4)
    centres, common = rng.normal(size=(5, 6)) * 2, rng.normal(size=6)
    owned = [(i, centres[rng.integers(5)] + rng.normal(size=6) * 0.3) for i in range(60) for _ in range(rng.integers(1, 5))]
    owned += [(i, common) for i in range(0, 60, 3)] + [owned[0], owned[0]] + [(61, owned[1][1]), (62, np.zeros(6))]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in owned] + [(70, None), (None, [1.0] * 6), (71, [float("nan")] * 6)], SCHEMA)
    got = sorted((r[0], r[1], r[2] + 0.0, r[3]) for r in similar.similar_entities(df, "id", "e", 4).collect())
    want = sorted(brute_entities(owned, 4))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(got, want))


def test_entities_by_hand(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [-1.0, 0.0]), (3, [3.0, 4.0])], SCHEMA)
    assert rows(similar.similar_entities(df, "id", "e", 2), "id", "rank") == [(1, 2, 1.0, 1), (1, 3, 0.8, 2), (2, 1, 1.0, 1), (2, 3, 0.8, 2), (3, 1, 0.8, 1), (3, 2, 0.8, 2)]
    assert similar.similar_entities(df.filter("id > 9"), "id", "e").count() == 0


def test_candidates_reach_the_recall(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 16))
    points = [(i, (centres[i % 20] + rng.normal(size=16) * 0.25).tolist()) for i in range(2000)]
    df = spark.createDataFrame(points, SCHEMA)
    asks = F.col("id") % 20 == 0
    found = similar.similar_candidates(df, "id", "e", asks, 5)
    exact = similar.similar_all(df, "id", "e", 5).filter(asks)
    assert similar.recall_at(found, exact, "id").first()["recall"] >= 0.9
    assert found.filter("id = neighbour_id").count() == 0 and found.groupBy("id").count().count() == 100


def test_only_some_rows_ask(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(8)
    copied = rng.normal(size=6)
    points = {i: rng.normal(size=6) for i in range(120)} | {i: copied for i in range(200, 230)}
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in points.items()], SCHEMA)
    report = {}
    got = similar.similar_all(df, "id", "e", 3, report, queries=F.col("id") % 20 == 5)
    assert sorted((r[0], r[1], r[2] + 0.0, r[3]) for r in got.collect()) == [r for r in brute(points, 3) if r[0] % 20 == 5]
    assert report["share"] < 0.2


def test_groups_do_not_grow_in_number():
    """A vector goes to no more groups when there are more vectors, until a group would not fit a task."""
    assert all(-(-n // search.group_rows(n, 64)) <= search.GROUPS for n in (10_000, 100_000, 600_000))
    assert all(8 * 64 * search.group_rows(n, 64) <= search.GROUP_BYTES for n in (600_000, 10 ** 8))


def test_leaves_find_what_all_pairs_find():
    rng = np.random.default_rng(9)
    points = np.abs(rng.normal(size=(4000, 8))) + 1
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    owner = rng.integers(0, 3000, size=4000)
    held = search._Held(points, owner, np.arange(4000), 5)
    asked = points[:50]
    keys, met = held.search(asked, np.full(50, -np.inf))
    exact = np.round(asked @ points.T, search.DECIMALS)
    for i in range(50):
        best = {}
        for o, s in zip(owner, exact[i]):
            best[o] = max(best.get(o, -9.0), s)
        want = sorted((-s, o) for o, s in best.items())[:5]
        got = sorted((-np.ceil(k / held.base) / 10 ** search.DECIMALS, held.others[int(p)]) for k, p in zip(keys[i], held.places(keys[i])))
        assert [o for _, o in got] == [o for _, o in want] and np.allclose([s for s, _ in got], [s for s, _ in want])
    assert met.mean() < 0.8 * 4000
