import math
import re
from collections import Counter

import pytest
import xxhash

from cohortsieve.llm import quality_rules as Q
from cohortsieve.llm.registry import QUERIES

SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def base(text):
    w = words(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in Q.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def buckets(text):
    w = words((text or "").lower())
    one = [xxhash.xxh64(x.encode(), 42).intdigest() for x in w]
    two = [xxhash.xxh64(y.encode(), h).intdigest() for h, y in zip(one, w[1:])]
    return [signed(h) % Q.BUCKETS for h in one + two]


TEXTS = [(1, "a b c a b c d"), (2, ""), (3, None), (4, "x\ty\x0bz # $$ é😀\n\n \nsame line\nsame line\n"), (5, "w " * 5000), (6, "a a a"),
         (6, "a a a a"), (None, "one two three four"), (7, "a b c d a b c")]


def test_base_counts(documents):
    got = Q.judge(documents(TEXTS), Q.QualityModel([0.0] * Q.BUCKETS, -math.inf)).collect()
    have = sorted((str(r[0]), *r[1:6], r["base_failed"]) for r in got)
    assert have == sorted((str(i), *(b := base(t)), b[0] < 50 or 100 * b[4] > 50 * b[0]) for i, t in TEXTS)
    assert all(r["score"] == 0.0 and r["kept"] == (not r["base_failed"]) for r in got)


@pytest.mark.parametrize("shipped", [Q.SHIPPED, 3])
def test_query_against_brute_force(spark, folder, monkeypatch, shipped):
    monkeypatch.setattr(Q, "SHIPPED", shipped)
    good = [(i, " ".join(f"plain{(i * j) % 61}" for j in range(60))) for i in range(1, 41)]
    junk = [(100 + i, " ".join(f"JUNK{(i * j) % 61}!!" for j in range(60))) for i in range(1, 21)]
    rows = good + junk + [(200, "short"), (201, None)]
    path = folder(documents=[(i, t, "en", "s", 0) for i, t in rows],
                  labels=[(i, 1, 0) for i, _ in good[:30]] + [(i, 0, 0) for i, _ in junk[:12]] + [(None, 1, 0), (5, None, 0)])
    got = {r["doc_id"]: r for r in QUERIES["op10_quality_rules"](spark, path).collect()}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(buckets(t))
        target.update(buckets(t) if i in {i for i, _ in good[:30]} else [])
    n, m = sum(raw.values()) + Q.BUCKETS, sum(target.values()) + Q.BUCKETS
    for i, t in rows:
        b = buckets(t)
        want = sum(math.log((target[x] + 1) / m) - math.log((raw[x] + 1) / n) for x in b) / len(b) if b else 0.0
        assert got[i]["score"] == pytest.approx(want, abs=1e-9)
    model = Q.fit(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    assert {i for i in got if got[i]["kept"]} == {r["doc_id"] for r in Q.judge(spark.read.parquet(f"{path}/documents.parquet"), model).filter("kept").collect()}
    assert all(got[i]["kept"] for i, _ in good) and not any(got[i]["kept"] for i, _ in junk) and not got[200]["kept"]


def test_keep_good_keeps_columns(spark, documents):
    model = Q.QualityModel([0.0] * Q.BUCKETS, -math.inf)
    docs = documents([(1, " ".join(map(str, range(60)))), (2, "few words"), (3, None)])
    docs = docs.selectExpr("*", "'x' as words", "1 as score", "2 as body", "3 as n_words")
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_nothing(spark, documents):
    none = documents([])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = Q.fit(none, labels)
    assert model.threshold == -math.inf and Q.judge(none, model).count() == 0


def test_threshold():
    assert Q.threshold_of([(0.0, False), (1.0, True), (2.0, True)]) == 0.5
    assert Q.threshold_of([(0.0, True)]) == -math.inf


def test_all_labels_count(spark):
    n = 24_000  # more than a bounded sample of 20,000 holds
    docs = spark.range(n).selectExpr("id as doc_id", "concat('common w', id % 7) as text")
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    weights = Q.fit(docs, labels).weights
    assert weights == pytest.approx([0.0] * Q.BUCKETS, abs=1e-12)  # all documents are trusted
    assert Q.cut_of([(0.0, 1, 900), (1.0, 999, 50)]) == 0.5 and Q.cut_of([(0.0, 6, 900), (1.0, 994, 50)]) == -math.inf
