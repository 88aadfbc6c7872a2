import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortsieve.llm import line_dedup as L
from cohortsieve.llm import steps
from cohortsieve.llm.registry import QUERIES

SPACES = " \t\n\x0b\x0c\r"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b):
    """Whether two different lines are near, by the docstring."""
    k = min(min(len(a), len(b)) // 100, 30)
    x, y = Counter(a), Counter(b)
    return abs(len(a) - len(b)) <= k and max((x - y).total(), (y - x).total()) <= k and distance(a, b) <= k


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        if not chars:
            break
        at, kind = rng.randrange(len(chars)), rng.random()
        if kind < 0.34:
            chars[at] = rng.choice("xyzé")
        elif kind < 0.67:
            chars.insert(at, rng.choice("xyzé"))
        else:
            chars.pop(at)
    return "".join(chars)


def prose(rng, n, letters="abcdefgh "):
    return "".join(rng.choice(letters) for _ in range(n)).strip().ljust(n, "x")


def brute(rows):
    """Per document (doc_id, text): its lines that count, the numbers of those that stay, and how many are near to an earlier one."""
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    found = {d: [(n, x.strip(SPACES)) for n, x in enumerate(d[2].split("\n")) if x.strip(SPACES)] for d in docs}
    first = {}
    for at, line in sorted((((d[:2], n, d[2]), line) for d in docs for n, line in found[d]), key=lambda r: r[0]):
        first.setdefault(line, at)
    late = {a for a in first if any(first[b] < first[a] and near(a, b) for b in first if b != a)}
    is_first = lambda d, n, x: first[x] == (d[:2], n, d[2])
    return {d: (len(f), [n for n, x in f if is_first(d, n, x) and x not in late], sum(is_first(d, n, x) and x in late for n, x in f)) for d, f in found.items()}


def check(spark, path, rows):
    got = QUERIES["op7_line_dedup"](spark, path).collect()
    want = brute(rows)
    expected = sorted((str(i), n, n - len(kept) - late, late, kept) for i, t in rows for n, kept, late in [want[(i is not None, i or 0, t or "")]])
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_exact"], r["n_near"], list(r["kept_lines"])) for r in got) == expected
    return want


def test_within(spark):
    rng = random.Random(5)
    pairs = [(a := prose(rng, rng.randrange(1, 90), "abcd "), edited(rng, a, rng.randrange(0, 9)), rng.randrange(0, 8)) for _ in range(600)]
    pairs += [(prose(rng, rng.randrange(1, 12), "ab"), prose(rng, rng.randrange(1, 12), "ab"), rng.randrange(0, 4)) for _ in range(300)]
    pairs += [(a := prose(rng, 400, "ab "), edited(rng, a, n), k) for n in (25, 30, 33, 40) for k in (12, 20, 30) for _ in range(4)]
    pairs += [(a := prose(rng, n, "ab\ufdd0\ufdd1"), edited(rng, a, 3), 3) for n in (20, 60) for _ in range(5)]
    pairs += [(a := prose(rng, n, "aé中\U0001f600 "), edited(rng, a, e), 4) for n in (50, 150) for e in (2, 4, 5, 7) for _ in range(8)]
    pairs += [("", "", 0), ("a", "", 1), ("", "abc", 2), ("", "abc", 3), ("ab", "abcd", 2), ("中文字" * 20, "中文子" + "中文字" * 19, 1)]
    got = spark.createDataFrame(pairs, "a string, b string, k int").select("a", "b", "k", L.within(F.col("a"), F.col("b"), F.col("k")).alias("w")).collect()
    assert [(r["a"], r["b"]) for r in got if r["w"] != (distance(r["a"], r["b"]) <= r["k"])] == []


@pytest.mark.parametrize("letters", ["abcdefgh ", "ab"])
def test_keys_find_every_near_pair(spark, letters):
    rng = random.Random(6)
    lines = [prose(rng, n, letters) for n in [100, 101, 199, 200, 201, 299, 300, 399, 400, 999, 1000, 3050] for _ in range(12)]
    budget = lambda a: min(len(a) // 100, 30)
    pairs = [(a, edited(rng, a, n), n) for a in lines for n in {1, budget(a)}]
    # All edits at one end, in one segment, or one in each.
    for a in lines:
        k = budget(a)
        each = "".join("é" + c if i % 50 == 0 and i // 50 < k else c for i, c in enumerate(a))
        pairs += [(a, b, k) for b in (a[k:], "é" * k + a, a[:60] + "é" * k + a[60:], each)]
    pairs = [(a, b) for a, b, n in pairs if n <= min(budget(a), budget(b))]
    rows = spark.createDataFrame([(i, *sorted(p, key=len)) for i, p in enumerate(pairs)], "i int, s string, l string")
    own, probes = (L.segment_keys(rows.select("i", F.col(c).alias("line"), F.length(c).alias("size")), p, "i") for c, p in (("s", False), ("l", True)))
    assert own.intersect(probes).select("i").distinct().count() == len(pairs) > 500
    assert rows.filter(~L._cells_left(F.col("s"), F.col("l"), L.budget(F.length("s")))).count() == 0
    likely = rows.select(*[x for c, n in (("s", "a"), ("l", "b")) for x in (F.length(c).alias(f"size_{n}"), L._letter_counts(F.col(c)).alias(f"letters_{n}"))])
    assert likely.filter(~L._likely("a", "b")).count() == 0


def corpus():
    rng = random.Random(7)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(60)) for _ in range(rng.randrange(3, 60))) for _ in range(40)]
    rows = []
    for i in range(60):
        picked = [edited(rng, b, rng.choice([0, 0, 1, 2, 3])) for b in rng.sample(base, 5)]
        rows.append((i, "\n".join(picked + ["", "Short", f"unique to {i} and to no other one {rng.random()}"])))
    rows += [(200 + 3 * i + n, edited(rng, base[i], len(base[i]) // 100 + n)) for i in range(40) for n in (-1, 0, 1)]
    return rows + [(100, None), (101, ""), (3, rows[3][1]), (102, rows[3][1]), (None, "a line of the document without a number"), (103, " \n\t"), (-5, rows[9][1]),
                   (7, "another text of seven\n" + rows[8][1])]


def test_query_against_brute_force(spark, folder):
    rows = corpus()
    want = check(spark, folder(documents=[(i, t, "en", "s", 0) for i, t in rows]), rows)
    assert sum(n for _, _, n in want.values()) > 40


def test_groups_whose_lines_are_not_all_near(spark, folder):
    rng = random.Random(9)
    rows, i = [], 0
    for n in (130, 420, 700):
        start = prose(rng, 60)
        base = start + prose(rng, n - 60)
        for _ in range(25):
            rows.append((i := i + 1, "\n".join([edited(rng, base, rng.randrange(n // 100 + 1)), start + prose(rng, n - 60)])))
    rng.shuffle(rows)
    want = check(spark, folder(documents=[(i, t, "en", "s", 0) for i, t in rows]), rows)
    assert 5 < sum(n for _, _, n in want.values()) < 75


def test_short_lines_stay(spark, folder):
    rows = [(1, "Tom: yes\n5 kg\nRed\nchapter 10\n2019\nprice 100 EUR\nLe.\nAnd."), (2, "Tim: yes\n8 kg\nBed\nchapter 12\n2021\nprice 950 EUR\nDe.\nAre."),
            (3, "版权所有翻印必究不得转载\nRed\n 2019 "), (4, "版权所有翻印必究不得转栽\nBed")]
    want = check(spark, folder(documents=[(i, t, "en", "s", 0) for i, t in rows]), rows)
    assert [want[True, i, t][1] for i, t in rows] == [list(range(8)), list(range(8)), [0], [0]]


def test_very_long_lines(spark, folder):
    rng = random.Random(10)
    word = lambda: prose(rng, rng.randrange(3, 9), "abcdefghijklmnop")
    line = " ".join(word() for _ in range(16000))
    texts = [line, line + "xyz", line[500:], edited(rng, line, 28), edited(rng, line, 3000), "y" * 100000, "y" * 99990, "y" * 99000]
    got = QUERIES["op7_line_dedup"](spark, folder(documents=[(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()
    assert len(line) > 90000 and {r["doc_id"]: r["n_near"] for r in got} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0, 5: 0, 6: 1, 7: 0}


def test_texts_without_repeats(spark, documents):
    rows = corpus()
    df = documents(rows).selectExpr("*", "1 as h", "2 as lines", "3 as kept_lines", "4 as row", "5 as at", "6 as id")
    out = L.drop_lines(df)
    got = {r["doc_id"]: r for r in out.collect() if r["doc_id"] not in (3, 7)}
    want = brute(rows)
    assert out.columns == df.columns and out.count() == len(rows)
    for i, t in rows:
        if i not in (3, 7):
            lines, kept = (t or "").split("\n"), want[(i is not None, i or 0, t or "")][1]
            text = "\n".join(x for n, x in enumerate(lines) if n in kept or not x.strip(SPACES))
            assert got[i]["text"] == (t if kept == [n for n, x in enumerate(lines) if x.strip(SPACES)] else text)
            assert got[i]["n_chars"] == (None if t is None else len(got[i]["text"]))


def test_nothing(documents):
    assert L.line_decisions(documents([])).count() == 0 == L.drop_lines(documents([])).count()


def test_rows_of(spark, monkeypatch):
    df = spark.range(-500, 500).withColumnRenamed("id", "k").withColumn("x", F.lit("t"))
    for wanted in ([], [3], list(range(-400, 0, 7))):
        ids = spark.createDataFrame([(i,) for i in wanted], "k long")
        for most in (1 << 24, 4096, 2):
            monkeypatch.setattr(steps, "MOST_BITS", most)
            assert sorted(r["k"] for r in steps.rows_of(df, "k", ids).collect()) == wanted


def test_bit_map_of_numbers_dealt_out_per_partition(spark):
    """Ids that differ in their high bits only do not fill the map."""
    df = spark.range(6400).selectExpr("(id % 64 << 33) + id div 64 as k")
    ids = df.filter(F.pmod(F.xxhash64("k"), F.lit(10)) == 0)
    assert ids.count() <= df.filter(steps.maybe_of("k", ids)).count() < 2000
    assert df.selectExpr("if(k = 0, null, k) as k").filter(F.col("k").isNull() & steps.maybe_of("k", ids)).count() == 0


def test_letter_counts_above(spark):
    rng = random.Random(12)
    pairs = [("a" * 300, "b" * 300), ("", "z" * 127), ("zzz", "")] + [(prose(rng, 90, "abghnouz"), prose(rng, 60, "abhotuvz")) for _ in range(50)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", L._counts_above(L._letter_counts(F.col("a")), L._letter_counts(F.col("b"))).alias("n"))
    cut = lambda t: Counter({c: min(n, 127) for c, n in Counter(t).items()})
    assert [r for r in df.collect() if r["n"] != (cut(r["a"]) - cut(r["b"])).total()] == []


def test_no_document_reaches_a_shuffle_of_the_join(spark, documents):
    assert re.search("Exchange", L._lines(documents(corpus()))._jdf.queryExecution().toString()) is None


def test_near_copies_beyond_the_budget_meet_once(spark):
    """Lines that share many segments are compared once, not once for each."""
    rows = [(i, True, 400, i, (0, 0, 0, 0), sorted(set(range(j % 3, 30 + i)) | {100 + i})) for i, j in enumerate([0, 1, 2, 1, 0, 2])]
    kind = "id long, asks boolean, size int, at long, letters struct<c0:long,c1:long,c2:long,c3:long>, keys array<bigint>"
    met = [tuple(r) for r in L.meeting_once(spark.createDataFrame(rows, kind)).collect()]
    assert sorted(met) == [(a, b) for a in range(6) for b in range(a + 1, 6)]


def test_trimmed(spark):
    rng = random.Random(13)
    rows = ["", " ", "\t\r", "a", " a", "a ", " a ", "é\r", "中 \x0b", "\x0c \U0001f600"]
    rows += ["".join(rng.choice("ab é　" + SPACES) for _ in range(rng.randrange(9))) for _ in range(300)]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", L._trimmed(F.col("t")).alias("x"), L._counts(F.col("t")).alias("n")).collect()
    assert [r for r in got if r["x"] != r["t"].strip(SPACES) or r["n"] != bool(r["x"])] == []


def test_cut(spark):
    rows = [(t, start, n) for t in ("abcdefghij", "aébc中d\U0001f600efg", "") for start in range(1, 11) for n in range(1, 12)]
    df = spark.createDataFrame(rows, "t string, start int, n int")
    cut = L._cut(F.col("t"), F.col("start"), F.col("n"), F.octet_length("t") == F.length("t"))
    assert [r for r in df.select("*", cut.alias("x")).collect() if r["x"] != r["t"][r["start"] - 1:][:r["n"]]] == []


def test_filters_keep_near_pairs_either_way_round(spark):
    rng = random.Random(14)
    budget = lambda a: min(len(a) // 100, 30)
    pairs = []
    for a in [prose(rng, n, "abcxyzé ") for n in (100, 199, 250, 333, 1050, 3050) for _ in range(15)]:
        k = rng.randrange(budget(a) + 1)
        # Edits of all kinds, and those of one kind only.
        pairs += [(a, b, k) for b in (edited(rng, a, k), "z" * k + a, "é" * k + a, a[k:], "x" * k + a[k:])]
    pairs = [p for a, b, k in pairs if k <= budget(b) for p in ((a, b), (b, a))]
    columns = [x for c, n in (("s", "a"), ("l", "b")) for x in (F.length(c).alias(f"size_{n}"), L._letter_counts(F.col(c)).alias(f"letters_{n}"))]
    df = spark.createDataFrame(pairs, "s string, l string").select(*columns)
    allowed = L._marks_allow(L._marks(F.col("letters_a")), L._marks(F.col("letters_b")), L.budget(F.least("size_a", "size_b")), F.abs(F.col("size_a") - F.col("size_b")))
    assert len(pairs) > 500 and df.filter(~L._likely("a", "b") | ~allowed).count() == 0


def test_pairs_are_ruled_out_by_compiled_code(spark):
    """Every pair of a list is asked for bits before a lambda, which Spark interprets; what leaves the join has likely counts by both."""
    kind = "id long, asks boolean, size int, at long, letters struct<c0:long,c1:long,c2:long,c3:long>, keys array<bigint>"
    far = 0x2A2A2A2A2A2A2A
    # The last one has a count of 127, which is one bit.
    rows = [(1, True, 400, 1, (0, 0, 0, 0), [1]), (2, True, 400, 2, (3, 1, 0, 0), [1]), (3, True, 401, 3, (far, 0, 0, 0), [1]),
            (4, True, 405, 4, (0, 0, 0, 0), [1]), (5, True, 400, 5, (0, 0, 0, 0x7F), [1])]
    met = L.meeting_once(spark.createDataFrame(rows, kind))
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("bit_count") < plan.index("lambda")
    # Counts are too far apart for four edits, or lengths.
    assert sorted(tuple(r) for r in met.collect()) == [(1, 2)]


def test_settings_of_a_written_step(spark, monkeypatch):
    before = [spark.conf.get(x) for x in (steps.HASHED_PARTITION, steps._CLEANUP)]
    seen = []
    monkeypatch.setattr(steps, "cut_lineage", lambda df, purpose: seen.append([spark.conf.get(x) for x in (steps.HASHED_PARTITION, steps._CLEANUP)]) or 1 // 0)
    with pytest.raises(ZeroDivisionError):
        steps.written(spark.range(1), "x", {steps.HASHED_PARTITION: "64m"})
    assert seen == [["64m", "true"]] and before == [spark.conf.get(x) for x in (steps.HASHED_PARTITION, steps._CLEANUP)]
