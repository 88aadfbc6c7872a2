import hashlib
import re

import pytest

from cohortsieve.llm import personal_data as pd_
from cohortsieve.llm.registry import QUERIES

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    spans = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                spans.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s[2] for s in sorted(spans)]


TEXTS = [
    (1, "Mail a.b+c@x-y.example.com. Or _z@q.org"), (2, "a@b.com_x@y.com and @c.d and e@f"), (3, "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255"),
    (4, "4111 1111 1111 1111, 4111-1111-1111-1112, 4111  1111 1111 1111"), (5, "+1 (788) 555-0037 +12 +123456789 +49.30.1234567-"),
    (6, ""), (7, None), (8, "é😀 a@b.co 😀 +1 222 333 4444 5"), (9, "9" * 30000), (10, "a." * 20000 + "@x"), (11, "a@" + "b." * 20000),
    (12, "+" + "1 " * 20000), (13, "1.1.1.1 " * 300), (13, "1.1.1.1"), (None, "x@y.de"), (14, "a@b.c@d.e 1.2.3.4@x.y")]


def test_base_spans_against_patterns(documents):
    got = pd_.find_spans(documents(TEXTS), pd_.SpanModel()).collect()
    assert len(got) == len(TEXTS)
    want = sorted((str(i), ",".join(base(t))) for i, t in TEXTS)
    have = sorted((str(r["doc_id"]), ",".join(f"{pd_.KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in r["base"])) for r in got)
    assert have == want


def test_query(spark, folder):
    clean = [(i, f"The report no. {i} of 2021 has 12 pages and 3.5 parts at the dot of it.") for i in range(60)]
    plain = [(100 + i, f"call +1 (788) 555-0{i:03d} or write to p.{i}@mail.example.com, host 10.0.{i}.7, no. 1.2.3.{300 + i}, +{i}55")
             for i in range(200)]
    variants = [(500, "reach john (at) mail [dot] example [dot] com today"), (501, "phone (788) 555-0037 please"),
                (502, "john at mail dot example dot com")]
    path = folder(documents=[(i, t, "en", "s", 1) for i, t in clean + plain + variants])
    got = QUERIES["op2_personal_data"](spark, path).toPandas().set_index("doc_id")
    for i, t in clean + plain + variants:
        spans = base(t)
        assert got.base_sha256[i] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(got.spans[i].split(",")) | {""}
        assert (got.n_email[i], got.n_ip[i], got.n_card[i], got.n_phone[i]) == tuple(
            sum(s.startswith(k) for s in spans) for k in PATTERNS)
    assert all(got.spans[i] == "" for i, _ in clean)
    assert got.spans[500] == "email:6:44" and got.spans[501] == "phone:6:20" and got.spans[502] == "email:0:32"


def test_cut():
    assert pd_.cut_for([(0.9, 10, 10), (0.5, 10, 10), (0.1, 20, 0)]) == pytest.approx(0.3)
    assert pd_.cut_for([(0.9, 10, 10)]) == 0.5
    assert pd_.cut_for([(0.9, 10, 5)]) == float("inf")


@pytest.mark.parametrize("table", [[], [(None, None)]])
def test_nothing(documents, table):
    assert pd_.fit(documents(table)).trees == []
    assert pd_.find_spans(documents(table), pd_.SpanModel()).count() == len(table)


def test_copies_do_not_fill_the_sample(spark, documents, monkeypatch):
    monkeypatch.setattr(pd_, "MAX_FIT", 400)
    texts = [f"unit {i} host 10.0.{10 + i % 90}.77 is up" for i in range(80)] + [f"unit {i} part 999.{i // 10}.{i % 10}.77 is up" for i in range(80)]
    model = pd_.fit(documents(list(enumerate(texts))).crossJoin(spark.range(500).select("id")))
    assert model.trees and model.thresholds["ip"] < 1


def test_context_decides(spark, documents, monkeypatch):
    monkeypatch.setattr(pd_, "MAX_FIT", 400)
    assert not {"checked", "n_digits"} & set(pd_.FEATURES)
    texts = [f"unit {i} host 10.0.{10 + i % 90}.77 is up" for i in range(80)] + [f"unit {i} part 999.{i // 10}.{i % 10}.77 is up" for i in range(80)]
    copied = documents(list(enumerate(texts))).crossJoin(spark.range(500).select("id"))
    model = pd_.fit(copied)
    assert model.trees and model.thresholds["ip"] < 1
    variants = [(1, "unit 5 host 10[.]0[.]11[.]77 is up"), (2, "unit 5 part 10[.]0[.]11[.]77 is up"), (3, "unit 5 host 10[.]0[.]999[.]77 is up")]
    found = {r["doc_id"]: [s["kind"] for s in r["all"]] for r in pd_.find_spans(documents(variants), model).collect()}
    assert found == {1: [1], 2: [], 3: []}
