import random
import re

import numpy as np
import pytest

from cohortsieve.llm import jaccard_join as J
from cohortsieve.llm.registry import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, gram):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return frozenset(tuple(w[i:i + gram]) for i in range(len(w) - gram + 1)) if len(w) >= gram else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, percent, gram):
    sets = [(i, shingles(t, gram)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(None if i is None else find(i))) for i, s in sets)


def corpus(seed, n=220):
    rng, rows = random.Random(seed), []
    common = " ".join(f"common{i}" for i in range(12))
    for i in range(n):
        size = rng.choice([1, 2, 3, 4, 6, 8, 10, 12, 15, 20, 30, 60, 120])
        if rows and rng.random() < 0.6:
            w = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                if w:
                    at = rng.randrange(len(w))
                    w[at:at + 1] = rng.choice([[], [f"new{rng.randrange(9)}"], [w[at], "more"]])
        else:
            w = [f"Word{rng.randrange(500)}" for _ in range(size)]
        rows.append((i, " ".join(w) + (" " + common if rng.random() < 0.3 else "")))
    # one group of near copies, all different
    body = [f"body{i}" for i in range(80)]
    for i in range(60):
        w = list(body)
        w[rng.randrange(80)] = f"edit{i}"
        rows.append((1000 + i, " ".join(w)))
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (5, rows[5][1]), (6, rows[7][1]), (None, rows[9][1]), (None, ""), (2003, "x " * 5000)]


@pytest.mark.parametrize("percent, gram, seed", [(85, 4, 1), (80, 5, 2)])
def test_against_brute_force(spark, documents, monkeypatch, percent, gram, seed):
    monkeypatch.setattr(J, "LONG_LIST", 5)
    rows = corpus(seed)
    got = J.with_components(documents(rows), percent, gram).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows, percent, gram)


def test_query(spark, folder):
    rows = corpus(3, 60)
    got = QUERIES["op8_jaccard_join"](spark, folder(documents=[(i, t, "en", "s", 0) for i, t in rows])).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows, 85, 4)


def test_nothing(documents):
    assert J.with_components(documents([])).count() == 0
    assert [tuple(r) for r in J.with_components(documents([(1, None)])).collect()] == [(1, 0, 1)]


def test_linked_light_sets_share_a_subset():
    rng, light = random.Random(1), 24
    universe = np.sort(np.array([rng.getrandbits(64) for _ in range(60)], np.uint64))
    for n in range(1, light + 1):
        for m in J.partners(n, 85):
            if m < n or m > light:
                continue
            o = J.needed(n, m, 85)
            if o > n or (n == m == o):
                continue
            a = np.sort(universe[:n])
            b = np.sort(np.concatenate((a[:o], universe[n:n + m - o])))
            assert set(J.subsets(a, light, 85)) & set(J.subsets(b, light, 85)), (n, m, o)
        assert len(J.subsets(universe[:n], light, 85)) == J.subset_counts(n, light, 85)


def test_boundary_follows_cost():
    assert 0 <= J.boundary({}, 85) <= J.MOST_LIGHT
    assert J.boundary({3: 1000, 4: 1000}, 85) >= 4
    assert J.boundary({24: 1000}, 85) < 24


def test_near_copies_beyond_the_threshold_meet_once(spark):
    """Sets that share many shingles are compared once, also where a first list is not shared."""
    rows = [(i, i, [(p, 1000 - p if p or i % 2 else 5000 + i) for p in range(8)], 200, 0, 0, 0, 0, 0) for i in range(1, 7)]
    kind = "k long, root long, in array<struct<place:int,e:long>>, n int, coarse long, p0 long, p1 long, p2 long, p3 long"
    met = [tuple(r) for r in J.meeting_once(spark.createDataFrame(rows, kind), 85).collect()]
    assert sorted(met) == [(a, b) for a in range(1, 7) for b in range(a + 1, 7)]


def test_words_of_a_batch():
    """Words are read from a batch's bytes; equal words have equal hashes, others do not, and no word goes beyond its text."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abAB zé中\t\n\x0b\x0c\r\x1c\0") for _ in range(rng.choice([0, 1, 2, 5, 40, 200]))) for _ in range(500)]
    texts += ["", "x" * 8, "x" * 9, "X" * 16, "x" * 17, "a\0", "a", "\0", "\0\0", "ab", "ab"]
    raw = [t.encode() for t in texts]
    h, at = J.word_hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(b) for b in raw]))
    hashes, words = {}, {}
    for i, t in enumerate(texts):
        want = [x for x in re.split(r"[\x20\x09-\x0D]+", t.translate(LOWER)) if x]
        assert len(want) == at[i + 1] - at[i]
        for word, x in zip(want, h[at[i]:at[i + 1]].tolist()):
            assert hashes.setdefault(word, x) == x and words.setdefault(x, word) == word


def test_parts_of_a_batch(monkeypatch):
    monkeypatch.setattr(J, "PART_BYTES", 10)
    batch = J.pa.RecordBatch.from_pydict({"text": ["a" * 4, "b" * 6, "", "c" * 25, "d", "é" * 5, "e"]})
    parts = [p.column("text").to_pylist() for p in J._parts(batch)]
    assert parts == [["a" * 4, "b" * 6, ""], ["c" * 25], ["d"], ["é" * 5], ["e"]]
