import random
import zlib
from collections import Counter

import numpy as np

from cohortsieve.llm import toxicity as T
from cohortsieve.llm.registry import QUERIES


def corpus(n, seed=1):
    rng, rows = random.Random(seed), []
    plain = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        for at in range(9, len(w), 10):
            w[at] += "."
        toxic = i % 4 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["grumpfkin", "zwockel", "brathuzz"])
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_kernel_is_a_kernel():
    words = ["zwockel", "zwxockel", "zockel", "table", "tables", "aaaa"]
    k = T.Kernel(words)
    m = np.array(k(words), float)
    assert np.allclose(m, m.T, atol=1e-5) and np.allclose(np.diag(m), 1, atol=1e-5)
    assert m[0, 1] > 0.1 and m[0, 2] > 0.1 and m[0, 3] == 0 and m[3, 4] > 0.3
    # against sums over all places
    def vector(w):
        w, v = f"^{w}$", {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for q in range(j + 1, min(len(w), i + T.SPAN)):
                    v[w[i], w[j], w[q]] = v.get((w[i], w[j], w[q]), 0) + T.DECAY ** (q - i - 2)
        return v
    a, b = vector("zwockel"), vector("zwxockel")
    near = sum(x * b.get(t, 0) for t, x in a.items()) / (sum(x * x for x in a.values()) * sum(x * x for x in b.values())) ** 0.5
    assert abs(m[0, 1] - (near - T.FLOOR) / (1 - T.FLOOR)) < 1e-4


def test_sentences():
    assert T.sentences("One two. Three!\n\nF.O.O x") == [["one", "two"], ["three"], ["f.o.o", "x"]]
    assert T.sentences("you b a d m a n here")[0][-1] == "badman"
    assert T.stretches("**tr-4sh!!") == ["trash"] and T.stretches("12-3") == ["12-3"] and len(T.stretches("x" * 100)) > 3


def test_query(spark, folder):
    rows = corpus(600)
    odd = [(9000, ""), (9001, None), (9002, "zw-o-c-k-e-l you"), (None, "quiet"), (9003, "x" * 20000)]
    path = folder(documents=[(i, t, "en", "s", 0) for i, t, _ in rows] + [(i, t, "en", "s", 0) for i, t in odd],
                  labels=[(i, 1, x) for i, _, x in rows] + [(None, 1, 1), (3, 1, None)])
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, path).collect()}
    assert len(got) == len(rows) + len(odd)
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows) and not got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [(got[i]["predicted"], x) for i, _, x in rows if got[i]["held_out"]]
    assert sum(p == x for p, x in held) >= 0.95 * len(held)
    assert got[9002]["predicted"] == 1 and got[9000]["predicted"] == got[9001]["predicted"] == 0 and got[9000]["score"] == got[9001]["score"]


def test_statistics_count_all_labels(spark, documents, monkeypatch):
    rows = corpus(300)
    known = spark.createDataFrame([(i, x) for i, _, x in rows if i % 7], "doc_id bigint, toxic int")
    got = T.word_statistics(documents([(i, t) for i, t, _ in rows] + [(900, None)]), known)
    counts = {0: Counter(), 1: Counter()}
    for i, t, x in rows:
        if i % 7:
            counts[x].update(T.words_of_text(t))
    n = Counter(x for i, _, x in rows if i % 7)
    odds = {w: T.log_odds(a, counts[0][w], n[1], n[0]) for w, a in counts[1].items() if a >= 2}
    best = sorted(odds, key=lambda w: (-odds[w] * np.log1p(counts[1][w]), w))[:T.TOXIC_LANDMARKS]
    assert list(got.odds)[:3] == best[:3] and set(got.odds) == set(best) and all(abs(got.odds[w] - odds[w]) < 1e-9 for w in best)
    assert {"grumpfkin", "zwockel", "brathuzz"} == set(best[:3])
    want = sorted((w for w in counts[0] if w not in counts[1] or odds.get(w, 1) < 0), key=lambda w: (-counts[0][w], w))
    assert got.clean == want[:T.CLEAN_WORDS]
    # An insult that is in none of the few documents of the fit still is a landmark.
    monkeypatch.setattr(T, "FIT_DOCS", 10)
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in rows], "doc_id bigint, quality int, toxic int")
    model = T.fit(documents([(i, t) for i, t, _ in rows]), labels)
    assert {"grumpfkin", "zwockel", "brathuzz"} <= set(model.landmarks)
    assert T.word_statistics(documents([]), known.filter("toxic = 1")) is None


def test_nothing(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert T.fit(documents([(1, "a b")]), labels) is None
    assert [tuple(r) for r in T.score_toxicity(documents([(2, "a"), (2, "a")]), None).collect()] == [(2, False, 0.0, 0)] * 2
    assert T.score_toxicity(documents([]), None).count() == 0


def test_word_statistics_do_not_shuffle_texts(spark, documents, monkeypatch):
    """A counted number of labels is broadcast; beyond it the statistics are the same."""
    docs = documents([(i, f"you vile{i % 3} thing" if i % 4 == 0 else f"a calm day number{i % 5}") for i in range(1, 60)])
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1, 50)], "doc_id long, toxic int")
    plans, write = [], T.written
    monkeypatch.setattr(T, "written", lambda df, purpose: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, purpose))
    found = T.word_statistics(docs, known)
    assert "strategy=broadcast" in plans[0]
    monkeypatch.setattr(T, "SHIPPED", 3)
    assert T.word_statistics(docs, known) == found and "strategy=broadcast" not in plans[1]
