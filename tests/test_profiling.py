import pytest
from helpers import as_dict, rows
from pyspark.sql import functions as F

from cohortsieve.operators import features, govern, profiling as P


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 20), (2, "a", None), (2, None, 150)], "id int, s string, age int")


def test_columns(df):
    want = [("age", "int", 1, 33.33, 2), ("id", "int", 0, 0.0, 2), ("s", "string", 1, 33.33, 1)]
    assert rows(P.profile_columns(df), "column") == want
    assert rows(P.profile_columns(df, approximate=True), "column") == want
    assert rows(P.profile_columns(df.limit(0)), "column")[0] == ("age", "int", 0, None, 0)


def test_values_shares_and_grain(df):
    assert rows(P.value_counts(df, "s", "age", "id"), "s", "age") == [(None, 150, 1, 1), ("a", None, 1, 1), ("a", 20, 1, 1)]
    assert rows(P.distribution(df, "s"), "s") == [(None, 1, 33.3), ("a", 2, 66.7)]
    assert rows(P.grain_violations(df, ["id"])) == [(2, 2)]
    assert rows(P.sample_rows(df, ["id", "age"], 1)) == [(1, "a", 20)]
    assert rows(P.table_counts({"t": df, "u": df.limit(1)}), "tbl") == [("t", 3), ("u", 1)]
    assert rows(P.readable({"t": df, "u": df.limit(0)}), "tbl") == [("t", True), ("u", False)]


def test_expectations(df):
    rules = {"age_plausible": F.col("age").between(18, 110), "id": F.col("id").isNotNull()}
    assert rows(P.expectation_report(df, rules), "expectation") == [("age_plausible", 1, 2), ("id", 3, 0)]
    assert P.expect(df, rules).count() == 3
    assert rows(P.expect(df, rules, "drop")) == [(1, "a", 20)]
    with pytest.raises(Exception, match="expectation violated"):
        P.expect(df, rules, "fail").collect()
    assert P.expect(df.filter("id = 1"), rules, "fail").count() == 1
    with pytest.raises(ValueError):
        P.expect(df, rules, "mend")


def test_checks(df):
    n = df.agg(F.count(F.lit(1)))
    got = as_dict(P.run_checks([P.Check("ok", n, 1, 3), P.Check("few", n, low=4), P.Check("many", n, high=2)]), "check", "passed")
    assert got == {"ok": True, "few": False, "many": False}


def test_vectors(spark):
    vec = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.0])], "id int, v array<float>")
    assert rows(P.vector_profile(vec, "v")) == [(3, 1, 2, 1)]
    assert rows(P.vector_profile(vec.limit(0), "v")) == [(0, None, None, 0)]


def test_identifiers_and_masks(spark):
    notes = spark.createDataFrame([(1, "write to a.b@mail.example.com or call 555-123-4567"), (2, "MRN-000123 seen 2024-05-01"),
                                   (3, "123-45-6789"), (4, "nothing")], "id int, t string")
    got = as_dict(P.identifier_scan(notes), "kind", "matches")
    assert got == {"email": 1, "phone": 1, "ssn": 1, "date": 1, "record_number": 1}
    shown = govern.mask(notes, {"t": "redact"}, "analyst")
    assert as_dict(shown, "id", "t") == {1: "write to [email] or call [phone]", 2: "[record_number] seen [date]",
                                         3: "[ssn]", 4: "nothing"}
    assert govern.mask(notes, {"t": "null"}, "analyst").filter("t is null").count() == 4
    assert len(govern.mask(notes, {"id": "hash"}, "analyst", "k").first()["id"]) == 64
    assert rows(govern.mask(notes, {"t": "null"}, "admin"), "id") == rows(notes, "id")


def test_row_filter_with_and_without_the_flag(spark):
    people = spark.createDataFrame([(1, True), (2, False)], "person_id int, is_high_profile boolean")
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "person_id int, s string")
    assert rows(govern.row_filter(facts, govern.protected_ids(people), "analyst")) == [(2, "y")]
    assert govern.row_filter(facts, govern.protected_ids(people.drop("is_high_profile")), "analyst").count() == 2
    assert govern.row_filter(facts, govern.protected_ids(people), "admin").count() == 2


def test_side_by_side(spark):
    facts = spark.createDataFrame([(2, "P"), (1, "N")], "p int, a string")
    notes = spark.createDataFrame([(1, 9, "x"), (2, 8, "y"), (3, 7, "z")], "p int, n int, t string")
    assert rows(P.side_by_side(facts, notes, "p", ["a"], "t", ["p", "n"], 5)) == [(1, "N", 9, "x"), (2, "P", 8, "y")]


def test_features(spark):
    facts = spark.createDataFrame([(1, "m", "b"), (1, "m", "c"), (1, "n", None), (2, "other", "z"), (3, "n", "q")],
                                  "p int, a string, v string")
    assert rows(features.pivot_long(facts, "p", "a", "v", {"m": "m1", "n": "n1"}), "p") == [(1, "c", None), (3, None, "q")]
    assert rows(features.flag_any(facts, "p", "v", {"f": ["c", "z"]}), "p") == [(1, True), (2, True), (3, False)]
    assert rows(features.top_codes(facts, "a", 2)) == [("m", 2), ("n", 2)]
    ages = spark.createDataFrame([(9,), (10,), (19,), (-1,), (None,)], "x int")
    assert rows(features.histogram(ages, "x", 10), "bin_start") == [(-10, 1), (0, 1), (10, 2)]
    profile = spark.createDataFrame([("P", None)], "a string, b string")
    assert rows(features.status_matrix(profile, {"a": "A", "b": "B"}), "marker") == [("A", "P", 1), ("B", "(missing)", 1)]


def test_first_rows_keep_null_order_values(spark):
    notes = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (3, 6, "c")], "id int, n int, t string")
    among = spark.createDataFrame([(1,), (2,)], "id int")
    assert sorted(r["t"] for r in P.first_rows(notes, among, "id", ["n"], 5).collect()) == ["a", "b"]


def test_hash_needs_a_key(spark):
    with pytest.raises(ValueError):
        govern.mask(spark.createDataFrame([(1,)], "id int"), {"id": "hash"}, "analyst")
