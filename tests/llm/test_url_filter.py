import os

import pytest
from compare import differences, duck

from cohortsieve.llm import url_filter as U
from cohortsieve.llm.registry import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(CHECKS))
def test_queries_against_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), duck(FOLDER), CHECKS[name]) is None


def test_rules_and_parts(spark, folder):
    urls = ["http://A.Example.com/en/1?x#y", "https://www.example.com/en/2", "http://m.www.example.com/fr/3", "ftp://x.net/es/", "http://x.net/fr",
            "nonsense", None, "http://com/", "http://x.com", "http://y.org#/en/", "a://b://c/d", "http://host.net/fr/\n1", "http://x.net/fr/1", "http://x.net/fr/1"]
    path = folder(pages=[(i, u, "") for i, u in enumerate(urls)], labels=[(1, 1, 0), (None, 0, 0), (2, None, 0)])
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in QUERIES["op4_url_filter"](spark, path).collect()}
    assert got == {
        0: ("a.example.com", "/en/1", "example.com/en/", "block"), 1: ("www.example.com", "/en/2", "www.example.com/en/", "allow"),
        2: ("m.www.example.com", "/fr/3", "com/", "allow"), 3: ("x.net", "/es/", "net/es/", "block"), 4: ("x.net", "/fr", None, "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("com", "/", "com/", "allow"), 8: ("x.com", "", None, "allow"),
        9: ("y.org", "", None, "allow"), 10: ("b:", "//c/d", None, "allow"), 11: ("host.net", "/fr/\n1", "net/fr/", "block"),
        12: ("x.net", "/fr/1", "net/fr/", "block"), 13: ("x.net", "/fr/1", "net/fr/", "block")}


def test_reputation_blocks_bad_hosts(spark):
    pages = [(i, f"https://{h}/de/{i}", "") for h, a in (("bad.a.org", 0), ("good.b.org", 100), ("few.c.org", 200)) for i in range(a, a + (2 if a == 200 else 60))]
    labels = [(i, int(i >= 100 and i < 200), 0) for i, _, _ in pages]
    got = U.judge_urls(spark.createDataFrame(pages + [(999, "https://new.a.org/x", "")], "page_id bigint, url string, html string"),
                       spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    by = {r["host"]: (r["verdict"], r["n_labelled"], r["n_bad"]) for r in got}
    assert by["bad.a.org"] == ("block", 60, 60) and by["good.b.org"] == ("allow", 60, 0) and by["new.a.org"][1] == 0
    mean = {r["host"]: r["mean"] for r in got}
    assert mean["good.b.org"] < mean["few.c.org"] <= mean["bad.a.org"] and mean["new.a.org"] > 0.4


def test_domains(spark):
    hosts = ["a.b.co.uk", "x.y.com", "com", "", "10.0.0.1", "u@h.example.org:8080"]
    df = U.with_domains(spark.createDataFrame([(h,) for h in hosts], "host string"))
    assert {r["host"]: (r["domain"], r["suffix"]) for r in df.collect()} == {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "com": ("com", ""), "": ("", ""), "10.0.0.1": ("10.0.0.1", ""),
        "u@h.example.org:8080": ("example.org", "org")}


def test_nothing(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert U.judge_urls(pages, labels).count() == 0
    with pytest.raises(ValueError):
        U.fitting_rule(U.RULES * 300)
