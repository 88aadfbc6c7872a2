import math
import random
from fractions import Fraction

import numpy as np
import pytest

from cohortsieve.llm import whitening as W
from cohortsieve.llm.registry import QUERIES


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d)).astype(np.float32).tolist()


ODD = [(900, None, 1), (901, [None] * 40, 1), (902, [math.nan] * 40, 1), (903, [math.inf] + [0.0] * 39, 1), (904, [1.0], 1), (905, [], None)]


def test_query_against_exact_arithmetic(spark, folder):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(150, 40))]
    rows += [rows[5], (None, rows[6][1], None), *ODD, *[(500 + i, rows[7][1], 0) for i in range(60)]]
    got = QUERIES["op11_embedding_whitening"](spark, folder(embeddings=rows)).toPandas()
    kept = [(i, v) for i, v, _ in rows if v and len(v) == 40 and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in kept]
    n, total = len(x), [sum(c) for c in zip(*x)]
    assert len(got) == 32 * n and set(got.n) == {n} and sorted(got.component.unique()) == list(range(1, 33))
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, total)) for row in x]
    first = got[got.component == 1]
    assert sorted(first.deviation) == sorted(deviation)
    mean = [Fraction(s, n) for s in total]
    centred = np.array([[float(a - m) for a, m in zip(row, mean)] for row in x])
    v = np.array([[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(40)] for i in range(40)])
    values, axes = np.linalg.eigh(v)
    for k in range(32):
        part = got[got.component == k + 1]
        want = centred @ axes[:, -1 - k] / np.sqrt(values[-1 - k])
        assert math.isclose(part.explained.iloc[0], values[-1 - k] / np.trace(v), rel_tol=1e-9)
        order = lambda ids, w: [z for _, z in sorted((str(i), round(float(z), 6)) for i, z in zip(ids, w))]
        ids = [None if i != i else int(i) for i in part.vec_id.astype(object)]
        assert order(ids, part.whitened) in (order([i for i, _ in kept], want), order([i for i, _ in kept], -want))
    assert set(got.identity_error) == {got.identity_error.iloc[0]} and 0 <= got.identity_error.iloc[0] < 1e-9


def test_covariance_is_exact():
    rng = random.Random(3)
    for scale in (10, 1 << 27, 1 << 58):
        x = np.array([[rng.randrange(-scale, scale) for _ in range(5)] for _ in range(30)], np.int64)
        rows, n = x.tolist(), 30
        found = W.totals(x)
        assert [found[i, i] for i in range(5)] == [sum(c) for c in zip(*rows)]
        centre = np.array([(2 * found[i, i] + n) // (2 * n) for i in range(5)], np.int64)
        rest = [found[i, i] - n * int(c) for i, c in enumerate(centre)]
        got = W.covariance(n, rest, W.squares(x, centre))
        y = [[n * v - found[i, i] for i, v in enumerate(r)] for r in rows]
        assert got == [[sum(r[i] * r[j] for r in y) for j in range(5)] for i in range(5)]
    for v in (0, 5, -7, 1 << 130, -(1 << 130) + 3):
        assert sum(p << W.LIMB * i for i, p in enumerate(W.limbs(v))) == v


def test_deviations_at_the_edge_of_a_long():
    for n, far in ((1 << 20, 1 << 11), (1 << 20, 1 << 12), (1 << 33, 5), (3, 1 << 30), (1, 3037000499), (1, 3037000500), (1 << 40, 1 << 40)):
        m = W.Whitening(n, np.zeros(2, np.int64), [n // 2 - 1, -1], np.ones(2), np.eye(2), 2.0)
        x = np.array([[far, 0], [0, 1], [-far, far]], np.int64)
        want = [sum((n * a - r) ** 2 for a, r in zip(row, m.rest)) for row in x.tolist()]
        assert m.deviations(x) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("rows", [[], ODD[:4], [(1, [0.5, 0.25], 0)], [(1, [0.5, 1.0], 0), (2, [0.5, 2.0], 0)], [(1, [1e30, 1.0], 0), (2, [-1e30, 2.0], 0)]])
def test_small_and_flat_tables(spark, folder, rows):
    got = QUERIES["op11_embedding_whitening"](spark, folder(embeddings=rows)).collect()
    usable = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    assert len(got) == sum(len(v) for _, v, _ in usable)
    scaled = [r for r in got if r["whitened"] is not None]
    assert len(scaled) == (len(usable) if len(usable) > 1 else 0)
    assert all(abs(abs(r["whitened"]) - 1) < 1e-9 and r["component"] == 1 for r in scaled)
    assert all(r["identity_error"] is None or r["identity_error"] < 1e-9 for r in got)


def test_whiten_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v, _ in [(j, v, 0) for j, v in enumerate(vectors(20, 3))] + [(99, None, 0), (98, [1.0], 0)]],
                               "whitened int, Embedding array<float>, deviation string")
    out = W.whiten(df, W.fit(df, "Embedding"), "Embedding", 2)
    assert out.columns == [*df.columns, "whitened_"] and out.count() == 22
    got = {r["whitened"]: r["whitened_"] for r in out.collect()}
    assert got[99] is None and got[98] is None and len(got[0]["values"]) == 2
