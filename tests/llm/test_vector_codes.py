import hashlib
import math
import random

import numpy as np
import pytest

from cohortsieve.llm import vector_codes as V
from cohortsieve.llm.registry import QUERIES

COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def brute(rows, length):
    """The contract, row by row."""
    kept = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows
            if v is not None and len(v) == length and all(c is not None and math.isfinite(c) for c in v)]
    w = length // 16
    part = lambda x, p: x[p * w:(p + 1) * w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]
    books = [[part(x, p) for _, x, _ in first] for p in range(16)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(part(x, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(2):
        members = [[[] for _ in b] for b in books]
        for _, x, _ in kept:
            for p in range(16):
                members[p][near(p, x)[1]].append(part(x, p))
        books = [[[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(ms, b)] for ms, b in zip(members, books)]
    out, by_label = [], {}
    for i, x, label in kept:
        found = [near(p, x) for p in range(16)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], sha) for i, c, e, label in out), key=str)


def table(n, length, seed, spread=0.2):
    rng = random.Random(seed)
    near = lambda: float(np.float32(rng.choice([rng.gauss(0, spread), rng.randrange(-3, 4) / 16])))
    rows = [(rng.randrange(10 ** 6), [near() for _ in range(length)], rng.choice([None, 0, 1, 2])) for _ in range(n)]
    rows += [rows[3], (None, rows[4][1], 5), (rows[5][0], rows[6][1], 0), *[(2 * 10 ** 6 + i, rows[7][1], 1) for i in range(50)]]
    return rows + [(1, None, 0), (2, [None] * length, 0), (3, [math.nan] * length, None), (4, [-math.inf] * length, 0), (5, [0.5], 0), (6, [], 1)]


@pytest.mark.parametrize("n, length, seed", [(300, 32, 1), (150, 64, 2), (40, 16, 3)])
def test_query_against_brute_force(spark, folder, n, length, seed):
    rows = table(n, length, seed)
    got = QUERIES["op13_vector_codes"](spark, folder(embeddings=rows))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, length)


def test_trie_in_small_subtrees(monkeypatch):
    rng = np.random.default_rng(4)
    for width in (1, 2, 5):
        parts = rng.integers(-6, 7, size=(600, width))
        entries = rng.integers(-6, 7, size=(20, width))
        leaves, place = V.distinct(parts)
        assert (leaves[place] == parts).all() and [tuple(x) for x in leaves.tolist()] == sorted({tuple(x) for x in parts.tolist()})
        all_ = ((leaves[:, None, :] - entries) ** 2).sum(axis=2)
        for size in (1, 7, 10 ** 6):
            monkeypatch.setattr(V, "LEAVES", size)
            code, distance = V.nearest(leaves, entries)
            assert (code == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()


def test_slices_give_the_same_codebooks(spark, folder, monkeypatch):
    df = spark.createDataFrame(table(200, 32, 5), "vec_id bigint, embedding array<float>, label int")
    whole = V.fit(df).sha256()
    assert V.fit(df.repartition(7)).sha256() == whole == V.fit(df.coalesce(1)).sha256()


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [math.nan], 0), (2, [], 1)]])
def test_nothing(spark, folder, rows):
    got = QUERIES["op13_vector_codes"](spark, folder(embeddings=rows))
    assert got.columns == COLUMNS and got.count() == 0


def test_other_lengths_and_far_components(spark, folder):
    rows = [(i, [float(i), 1e30, -1e30], i % 2) for i in range(5)]
    got = {r["vec_id"]: r for r in QUERIES["op13_vector_codes"](spark, folder(embeddings=rows)).collect()}
    assert {r["error"] for r in got.values()} == {0} and got[3]["code"] == "03" + "00" * 15
    assert [x.stop - x.start for x in V.cuts(18, 16)] == [2, 2] + [1] * 14 and V.bound(64) == 1 << 27
    assert 64 * (2 * V.bound(64)) ** 2 < 1 << 63 and 100 * (2 * V.bound(100)) ** 2 < 1 << 63


def test_columns_and_labels_stay(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i % 3), 1.0], i % 4 or None, "x") for i in range(40)] + [(99, None, 1, "y")],
                               "vec_id long, embedding array<double>, coded int, error string")
    out = V.compress(df, V.fit(df))
    assert out.columns == [*df.columns, "coded_"] and out.count() == 41 and out.filter("vec_id = 99 and coded_ is null").count() == 1
    rows = spark.createDataFrame([(i % 7 or None, i) for i in range(70)], "g int, e long")
    want = {g: sum(i for i in range(70) if (i % 7 or None) == g) for g in {i % 7 or None for i in range(70)}}
    for hot in (1000, 7, 1):
        monkeypatch.setattr(V, "HOT", hot)
        got = V.with_group_error(rows, "g", "e", "s").collect()
        assert len(got) == 70 and all(r["s"] == want[r["g"]] for r in got)
