import random
import re
import struct
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import xxhash
from pyspark.sql import functions as F

from cohortsieve.llm import mixing as M
from cohortsieve.llm.registry import QUERIES


def hashed(*values):
    """xxhash64 of Spark: integers by their bytes, NULL skipped, each value seeded with the hash so far."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else struct.pack("<q", v[0]) if isinstance(v, tuple) else struct.pack("<i", v)
            seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def permuted(x, m, *key):
    for i in range(1, M.ROUNDS + 1):
        other = (hashed(M.SEED, i, *key) % m - x) % m
        if hashed(M.SEED, i, (max(x, other),), *key) % 2 == 0:
            x = other
    return x


def brute(rows, block=M.BLOCK):
    """The mix, word by word: (words taken of each distinct document, source sizes, targets)."""
    copies = Counter((s, i, t or "") for i, t, s in rows)
    names = sorted({s for s, _, _ in copies}, key=lambda s: (s is None, s or ""))
    size = {s: sum(len(words(t)) * n for (x, _, t), n in copies.items() if x == s) for s in names}
    weight = {s: M.WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, above = {}, set()
    while len(target) < len(names):
        rest = sum(size.values()) - sum(3 * size[s] for s in above)
        share = {s: Fraction(rest * weight[s], sum(weight[x] for x in names if x not in above)) for s in names if s not in above}
        more = {s for s in share if share[s] > 3 * size[s]}
        target = {s: Fraction(3 * size[s]) if s in above else share[s] for s in names} if not more else {}
        above |= more
        if len(above) == len(names):
            target = {s: Fraction(3 * size[s]) for s in names}
    taken = Counter()
    for s in names:
        documents = [(i, t) for x, i, t in copies if x == s]
        buckets = -(-len(documents) // M.BUCKET)
        key = lambda d: (hashed(None if d[0] is None else (d[0],), (hashed(d[1]),)))
        documents.sort(key=lambda d: (key(d) % buckets, key(d), d[0] is not None, d[0] or 0, hashed(d[1])))
        stream = [(s, i, t) for i, t in documents for _ in range(copies[s, i, t] * len(words(t)))]
        blocks = [stream[k:k + block] for k in range(0, len(stream), block)]
        full, missing, epoch = len(stream) // block, int(target[s]), 0
        while missing:
            order = [permuted((k,)[0], full, s, (epoch,)) for k in range(full)] + list(range(full, len(blocks)))
            for k in order:
                used = blocks[k][:missing]
                taken.update(used)
                missing -= len(used)
            epoch += 1
    return copies, taken, size, target


def corpus(seed, n, sources):
    rng = random.Random(seed)
    rows = [(i, " ".join("w%d" % rng.randrange(99) for _ in range(rng.choice([0, 1, 5, 40, 90]))), rng.choice(sources)) for i in range(n)]
    rows += [(n + 1, None, sources[0]), (n + 2, "", None), (n + 3, " \n\t", sources[0]), (None, "no number here", sources[0])]
    return rows + [rows[3]] * 3 + [rows[4]] * 40 + [(rows[5][0], "same id, other text", rows[5][2])]


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("taken", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("sources, bucket", [(["a", "b", "", None], 512), (["news"] * 9 + ["wiki", "Z", "é", "中", "\U0001f600"], 16), (["one"], 8)])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, sources, bucket):
    monkeypatch.setattr(M, "BUCKET", bucket)
    monkeypatch.setattr(M, "FAN", 4)
    monkeypatch.setattr(M, "CHUNK", 7)
    rows = corpus(len(sources), 260, sources)
    got = QUERIES["op12_source_mixing"](spark, write(spark, tmp_path, rows))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    copies, taken, size, target = brute(rows)
    want = [(str(i), len(words(t)), size[s], float(target[s]), (2 * taken[s, i, t or ""] + c) // (2 * c))
            for i, t, s in rows for c in [copies[s, i, t or ""]]]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted(want)
    assert all(t <= 3 * n for _, n, _, _, t in want)
    for s in size:
        assert abs(sum(v for k, v in taken.items() if k[0] == s) - target[s]) < 1


def test_texts_of_the_mix(spark):
    rows = corpus(2, 120, ["a", "b", "c", None])
    docs = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id bigint, text string, source string, position int")
    mixed = M.mix(docs, block=32, shard=8)
    slots = mixed.slots.collect()
    assert sorted(r["position"] for r in slots) == list(range(len(slots))) and all(r["shard"] == r["position"] // 8 for r in slots)
    counts = {(r["shard"], r["sid"]): r["n"] for r in mixed.shard_counts().collect()}
    assert counts == Counter((r["shard"], r["sid"]) for r in slots)
    by_epoch = defaultdict(list)
    for r in slots:
        by_epoch[r["sid"], r["epoch"]].append(r["block"])
    assert all(len(set(b)) == len(b) for b in by_epoch.values())
    per_slot, out = Counter(), mixed.texts(docs).collect()
    for r in out:
        per_slot[r["position"]] += len(words(r["words"]))
    assert per_slot == {r["position"]: r["words"] for r in slots}
    known = {(i, w) for i, t, _ in rows for w in words(t)}
    assert all((r["doc_id"], w) in known for r in out for w in words(r["words"]))
    copies, _, _, target = brute(rows, 32)
    assert sum(per_slot.values()) == sum(int(t) for t in target.values())
    taken = Counter()
    for r in mixed.taken().collect():
        taken[r["doc_id"]] += r["taken"]
    seen = Counter()
    for r in out:
        seen[r["doc_id"]] += len(words(r["words"]))
    assert seen == +taken


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None)], [(1, "only", None)]])
def test_small_tables(spark, tmp_path, rows):
    got = sorted(tuple(r) for r in QUERIES["op12_source_mixing"](spark, write(spark, tmp_path, rows)).collect())
    n = sum(len(words(t)) for _, t, _ in rows)
    assert got == [(i, len(words(t)), n, float(n), len(words(t))) for i, t, _ in rows]


def test_permutations(spark):
    for m in (1, 2, 3, 10, 257, 1000):
        got = [r[0] for r in spark.range(m).select(M.permuted(F.col("id"), F.lit(m).cast("long"), F.lit("s"), F.lit(1).cast("long"))).collect()]
        assert sorted(got) == list(range(m)) and got == [permuted(x, m, "s", (1,)) for x in range(m)]
        if m > 100:
            assert sum(a == b for a, b in enumerate(got)) < 12 and sum(abs(a - b) < m // 10 for a, b in zip(got, got[1:])) < m // 3


def test_shares():
    assert M.targets([100, 100, 100], [5, 2, 1]) == [Fraction(1500, 8), 75, Fraction(75, 2)]
    assert M.targets([1, 10, 89], [5, 2, 1]) == [3, 30, 67]
    assert M.targets([0, 0], [5, 2]) == [0, 0] and M.targets([], []) == [] and M.targets([7], [5]) == [7]


def test_too_many_sources(spark, monkeypatch):
    monkeypatch.setattr(M, "SOURCES", 2)
    with pytest.raises(ValueError):
        M.mix(spark.createDataFrame([(i, "x", str(i)) for i in range(3)], "doc_id long, text string, source string"))
