import random
import re

from cohortsieve.llm import decontaminate as D
from cohortsieve.llm.registry import QUERIES


def least(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_myers():
    rng = random.Random(1)
    for _ in range(800):
        p = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 90)))
        t = "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 99)))
        d = least(p, t)
        assert D.myers(p, t, 90) == d and D.myers(p, t, d - 1) is None


def setup(rng):
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    items = [(i, words(rng.randrange(6, 45))) for i in range(12)] + [(12, "tiny one"), (13, None), (None, words(9)), (14, "")]
    rows = [(i, words(60)) for i in range(20)]
    for n, (i, text) in enumerate(items[:12]):
        chars = list(text)
        for _ in range(n % 4):
            chars[rng.randrange(len(chars))] = "#"
        rows.append((100 + n, words(8) + "\n " + "".join(chars).upper().replace(" ", "  ") + " " + words(8)))
    half = items[11][1]
    return items, rows + [(200, half[:len(half) // 2 + 60]), (300, None), (301, ""), (302, "a tiny one."), (303, "tiny ones"), (100, rows[20][1])]


def brute(items, text):
    """Items with a stretch of 100 characters (or all of a shorter one), from every 20th place or at the end, within 4 % edits; short ones as whole words."""
    t, found = " ".join((text or "").lower().split()), set()
    for i, x in items:
        x = " ".join((x or "").lower().split())
        if i is None or not x or not t:
            continue
        if len(x) < 25:
            hit = re.search(r"(?<![^\W_])" + re.escape(x) + r"(?![^\W_])", t)
        else:
            hit = any(least(x[s:s + 100], t) <= int(min(len(x), 100) * 0.04) for s in {*range(0, max(len(x) - 100, 1), 20), max(len(x) - 100, 0)})
        found |= {i} if hit else set()
    return sorted(found)


def test_every_part_of_the_certain_length_is_found():
    rng = random.Random(5)
    item = D.plain("".join(rng.choice("abcdefgh ") for _ in range(400)))
    finder = D.Finder(D.windows(1, item))
    noise = lambda: "".join(rng.choice("uvwxyz ") for _ in range(90))
    assert D.CERTAIN == 119
    for size in (D.CERTAIN, 130, 180):
        for start in range(len(item) - size + 1):
            assert finder.items(noise() + item[start:start + size] + noise()) == [1]
    # Also with as many edits as a window allows, spread over the part.
    for start in range(0, len(item) - 200, 7):
        part = list(item[start:start + 200])
        for at in range(10, 200, 50):
            part[at] = "#"
        assert finder.items(noise() + "".join(part) + noise()) == [1]
    assert not any(finder.items(noise() + item[s:s + 60] + noise()) for s in range(0, 300, 11))


def test_short_items_match_as_whole_words():
    items = [(1, "42 km"), (2, "Yes."), (3, "blue whale"), (4, " "), (None, "fish")]
    finder = D.Finder([w for i, t in items for w in D.windows(i, t)])
    assert [finder.items(t) for t in ("It is 42  KM far", "142 km", "42 kmh", "yes. (blue whale)", "blue whales", "fish")] == [[1], [], [], [2, 3], [], []]


def test_query_against_brute_force(spark, folder, monkeypatch):
    items, rows = setup(random.Random(2))
    monkeypatch.setattr(D, "BLOCK", 20)
    path = folder(documents=[(i, t, "en", "s", 0) for i, t in rows], benchmark=items)
    got = QUERIES["op9_decontaminate"](spark, path).collect()
    want = sorted((i, brute(items, t)) for i, t in rows)
    assert sorted((r["doc_id"], list(r["item_ids"])) for r in got) == want
    assert all(r["contaminated"] == bool(r["item_ids"]) for r in got) and sum(bool(x) for _, x in want) >= 8
    assert not any(x for i, x in want if i < 100)


def test_columns_and_empty_tables(spark, documents):
    docs = documents([(1, "a"), (None, None)]).selectExpr("*", "'x' as item_ids")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.decontaminate(docs, none).columns == docs.columns and D.decontaminate(docs, none).count() == 2
    one = spark.createDataFrame([(1, "some longer benchmark item text that stands here")], "item_id bigint, text string")
    assert D.decontaminate(docs, one).count() == 2 and D.decontaminate(docs.limit(0), one).count() == 0
