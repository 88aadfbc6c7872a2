import random

import corpus_pipeline as P
from cohortsieve.llm import decontaminate as D
from cohortsieve.llm import quality_rules as Q
from cohortsieve.llm.pieces import Pieces, default_model
from cohortsieve.session import cut_lineage
from test_jaccard_join import brute as components
from test_line_dedup import brute as lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    prose = lambda n: "\n".join(" ".join(rng.choice(vocabulary) for _ in range(25)) for _ in range(n))
    items = [(i, prose(1)) for i in range(5)]
    rows = [(i, prose(4)) for i in range(40)]
    rows += [(100 + i, " ".join(f"JUNK{rng.randrange(30)}!!" for _ in range(80))) for i in range(20)]
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    rows += [(210 + i, rows[i][1].replace("\n", " \n", 1).replace(rows[i][1][:4], "odd", 1)) for i in range(5, 10)]
    rows += [(300 + i, prose(2) + "\n" + t + "\n" + prose(2)) for i, t in items] + [(400, "short"), (401, None), (402, "")]
    labels = [(i, 1, 0) for i in range(25)] + [(100 + i, 0, 0) for i in range(12)]
    return rows, items, labels


def test_stages_against_brute_force(spark, folder):
    rows, items, labels = tables()
    path = folder(documents=[(i, t, "en", "s", len(t or "")) for i, t in rows], benchmark=items, labels=labels)
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), dict(rows)

    def step(n, want):
        nonlocal docs
        docs = cut_lineage(P.STAGES[n][1](spark, docs, path), "stage")
        assert docs.columns == COLUMNS
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert got == want
        return want

    model = Q.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    good = {r["doc_id"] for r in Q.judge(docs, model).filter("kept").collect()}
    assert {i for i, _ in rows[:40]} <= good and not good & set(range(100, 120)) and 400 not in good
    kept = step(0, {i: t for i, t in kept.items() if i in good})

    answers, want = lines(list(kept.items())), {}
    for i, t in kept.items():
        n, stay, _ = answers[(True, i, t)]
        parts = t.split("\n")
        rest = "\n".join(x for k, x in enumerate(parts) if k in stay or not x.strip())
        if rest.split():
            want[i] = rest
    assert len(want) < len(kept)
    kept = step(1, want)
    kept = step(2, {i: kept[i] for i in (int(a) for a, _, c in components(list(kept.items()), 80, 5) if a == c)})
    found = {i for i, t in kept.items() if any(D.myers(w.text, D.plain(t), w.budget) is not None for j, x in items for w in D.windows(j, x))}
    assert found >= {300, 301, 302, 303, 304}
    kept = step(3, {i: t for i, t in kept.items() if i not in found})
    with open(default_model(), "rb") as f:
        sp = Pieces(f.read()).sp
    out = {r["doc_id"]: list(r["token_ids"]) for r in P.STAGES[4][1](spark, docs, path).collect()}
    assert out == {i: sp.encode(t) for i, t in kept.items()}
