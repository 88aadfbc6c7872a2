import re

import pandas as pd
import pytest
from helpers import as_dict, rows
from pyspark.sql import functions as F

from cohortsieve.functions import clauses as C
from cohortsieve.functions import rules as R
from cohortsieve.functions.statuses import normalise_status, parse_response
from cohortsieve.operators import coverage, extract, fuse
from cohortsieve.sources import reports

# report, careful, terse; own sentences with hand-set answers
HER2 = [
    ("HER2 staining graded 3+ in all fields", "Positive", "Unknown"),
    ("HER2: positive in the invasive part", "Positive", "Positive"),
    ("Her-2: 1+ on two blocks", "Negative", "Unknown"),
    ("HER2/neu was negative", "Negative", "Negative"),
    ("HER2 gene not amplified", "Negative", "Unknown"),
    ("HER2: 2+ (equivocal); FISH amplified", "Positive", "Unknown"),
    ("HER2: 2+ (equivocal by IHC), not 3+", "Unknown", "Unknown"),
    ("HER2: 2+, equivocal, FISH ordered", "Unknown", "Unknown"),
    ("HER2: 2+ with a FISH ratio of 2.6 and a copy number of 6.0", "Positive", "Unknown"),
    ("HER2: 2+ with a FISH ratio of 2.6 and a copy number of 3.0", "Negative", "Unknown"),
    ("HER2: 2+ with a FISH ratio: 1.2", "Negative", "Unknown"),
    ("HER2 testing was requested.\nSpecimen adequate.\nHER2: Positive (3+)", "Positive", "Positive"),
    ("CLINICAL HISTORY: prior HER2-negative primary.\nHER2: Positive (3+)", "Positive", "Positive"),
    ("Prior biopsy was HER2-negative.", "Unknown", "Unknown"),
    ("HER2: 2+ (equivocal)\nADDENDUM\nHER2 FISH: ratio 2.4, average HER2 copy number 5.1", "Positive", "Unknown"),
    ("HER2: 2+ (equivocal)\nFISH ratio 2.4, average HER2 copy number 5.1", "Positive", "Unknown"),
    ("HER2: 2+ (equivocal)\n  ratio 1.3", "Negative", "Unknown"),
    ("HER2 will be reported in an addendum", "Unknown", "Unknown"),
    ("No marker named here", "Unknown", "Unknown"),
]
ER = [
    ("ER: 85% of nuclei stain", "Positive", "Unknown"),
    ("ER: positive in >95% cells, <1% background", "Positive", "Positive"),
    ("ER: positive", "Positive", "Positive"),
    ("ER status: negative", "Negative", "Negative"),
    ("Estrogen receptor: <1%", "Negative", "Unknown"),
    ("Estrogen receptor: 0.4% of nuclei, weak", "Negative", "Unknown"),
    ("Estrogen receptor: 1% of nuclei, weak", "Positive", "Unknown"),
    ("Estrogen receptor: non-reactive", "Negative", "Unknown"),
    ("ER: requested\nER: positive\n(70% of nuclei)", "Positive", "Positive"),
    ("History: ER: negative\nER: 30%", "Positive", "Unknown"),
    ("The WHOLE SUPERIOR text, er sagte nichts", "Unknown", "Unknown"),
]


@pytest.mark.parametrize("marker, cases", [("her2_status", HER2), ("er_status", ER)])
def test_rules(spark, marker, cases):
    df = spark.createDataFrame([(i, f"Report.\n{line}\nEnd.") for i, (line, _, _) in enumerate(cases)], "id int, t string")
    for n, rules in ((1, R.CAREFUL), (2, R.TERSE)):
        got = as_dict(extract.extract(df, "t", rules), "id", marker)
        assert got == {i: c[n] for i, c in enumerate(cases)}


@pytest.mark.parametrize("n, rules", [(1, R.CAREFUL), (2, R.TERSE)])
def test_reports_with_hand_set_answers(spark, n, rules):
    entries = reports.REPORTS + reports.PANELS
    df = spark.createDataFrame([(i, f"Some prose.\n{e[0]}\nMore prose.") for i, e in enumerate(entries)], "id int, t string")
    got = {r["id"]: "".join(r[f"{m}_status"][0] for m in reports.MARKERS) for r in extract.extract(df, "t", rules).collect()}
    assert {e[0]: got[i] for i, e in enumerate(entries)} == {e[0]: e[n] for e in entries}


def test_assertions(spark):
    told = {"previously 3+": "history", "in 2015": "history", "her sister had cancer": "history", "FISH ordered": "request", "not performed": "request",
            "if positive": "request", "3+ by IHC": "result", "Historic building": "result", "prior test not done": "request"}
    df = spark.createDataFrame([(k,) for k in told], "t string")
    assert as_dict(df.withColumn("a", C.assertion(F.col("t"))), "t", "a") == told


def test_lines_that_go_on(spark):
    cases = [("a\nER 1\n(b)\n(c)\nd\n(e)", ["ER 1 (b) (c)"]), ("(x)\nER 1\nER 2\n(y)", ["ER 1", "ER 2 (y)"]), ("none", []), ("", [])]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = as_dict(df.withColumn("j", C.joined(F.col("t"), R.may_name, R.GOES_ON)), "t", "j")
    assert got == dict(cases)


def test_markers_on_one_line_do_not_mix(spark):
    df = spark.createDataFrame([("ER: positive; PR: negative, HER2 3+ by IHC. Ki-67 30%",), ("ER/PR: Positive",)], "t string")
    assert rows(extract.extract(df, "t").drop("t")) == [("Positive", "Positive", "Negative"), ("Unknown", "Positive", "Positive")]


def test_line_filter_drops_no_statement(spark):
    lines = [c[0] for c in HER2 + ER if "\n" not in c[0] and not re.search(C.HISTORY_CUE, c[0]) and not re.search(C.REQUEST_CUE, c[0])] + ["Her2 3+", "her-2: negative", "HER-2 positive", "PROGESTERONE RECEPTOR: NEGATIVE"]
    df = spark.createDataFrame([(f"x\n{line}",) for line in lines], "t string")
    for marker in R.STATEMENT:
        whole, kept = R.statements(F.col("t"), marker), R.statements(R.marker_lines(F.col("t")), marker)
        assert df.filter(~whole.eqNullSafe(kept)).count() == 0


def test_null_text_is_unknown(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert extract.extract(df, "t").first()["her2_status"] == "Unknown"


def test_each_configuration_from_one_pass(spark):
    df = spark.createDataFrame([(1, HER2[8][0])], "id int, t string")
    got = extract.extract_each(df, "t", {"careful": R.CAREFUL, "terse": R.TERSE})
    assert as_dict(got, "config", "her2_status") == {"careful": "Positive", "terse": "Unknown"}


def test_responses_of_every_shape(spark):
    answers = ['{"a": "x"}', '{"result": {"a": "y"}}', '```json\n{"a": "z"}\n```', "no idea", None, "{}"]
    df = spark.createDataFrame(list(enumerate(answers)), "id int, t string")
    got = as_dict(df.select("id", parse_response(F.col("t"), "a string").alias("p")), "id", "p")
    assert [got[i] and got[i]["a"] for i in range(6)] == ["x", "y", "z", None, None, None]


def test_normalise(spark):
    df = spark.createDataFrame([("Positive",), ("equivocal",), (None,)], "s string")
    assert rows(df.select(normalise_status(F.col("s")))) == [("Positive",), ("Unknown",), ("Unknown",)]


def test_user_model(spark):
    def model(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: '{"result": {"n": %d}}' % len(t))

    df = spark.createDataFrame([("abc",), ("a" * 20000,)], "t string")
    assert rows(extract.extract_with(df, "t", model, "n int", partitions=2).select("n"), "n") == [(3,), (20000,)]


def test_latest_note_wins(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 12, "b"), (2, 3, "c")], "p int, n int, s string")
    assert rows(extract.one_per_entity(df, "p", "n"), "p") == [(1, 12, "b"), (2, 3, "c")]


def test_recovery_and_agreement(spark):
    gap = spark.createDataFrame([(1,), (2,), (3,), (3,)], "p int")
    read = spark.createDataFrame([(1, "Positive"), (2, "Unknown")], "p int, s string")
    assert rows(extract.recovery(gap, read, "p", "s")) == [(3, 2, 1)]
    gold = spark.createDataFrame([(1, "Positive"), (2, "Negative"), (9, None)], "p int, s string")
    assert rows(extract.agreement(gold, read, "p", "s")) == [(2, 1, 50.0)]
    assert rows(extract.agreement(gold.filter("p > 99"), read, "p", "s")) == [(0, 0, None)]


def test_coverage_and_not_in(spark):
    people = spark.createDataFrame([(1,), (2,), (3,), (4,)], "p int")
    facts = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "p int")
    notes = spark.createDataFrame([(1,), (3,), (3,), (None,)], "p int")
    got = as_dict(coverage.coverage(people, facts, notes, "p"), "p", "evidence")
    assert got == {1: "both", 2: "structured-only", 3: "notes-only", 4: "neither"}
    assert rows(coverage.only_in(notes, facts, "p")) == [(3,)]
    keys = spark.createDataFrame([(1,), (5,), (None,)], "p int")
    assert rows(coverage.not_in(keys, "p", facts)) == []
    assert rows(coverage.not_in(keys, "p", facts.filter("p is not null"))) == [(5,)]
    assert len(rows(coverage.not_in(keys, "p", facts.filter("p > 100")))) == 3


def test_fusion(spark):
    facts = spark.createDataFrame([(1, "Negative", None), (2, "Positive", "Positive")], "p int, a string, b string")
    notes = spark.createDataFrame([(1, "Positive", "Negative"), (3, "Unknown", None)], "p int, a string, b string")
    assert rows(fuse.fuse(facts, notes, "p", ["a", "b"]), "p") == [
        (1, "Negative", "Negative", "structured"), (2, "Positive", "Positive", "structured"), (3, "Unknown", None, "nlp")]
    three = fuse.fuse(facts, notes, "p", ["a", "b"], three_way=True, per_column=True)
    assert rows(three.select("p", "biomarker_source", "b_source"), "p") == [
        (1, "both", "nlp"), (2, "structured", "structured"), (3, "nlp", None)]
    people = spark.createDataFrame([(1,), (3,), (4,)], "p int")
    onto = fuse.fuse_onto(people, facts, notes, "p", ["a", "b"])
    assert rows(onto, "p") == rows(fuse.fuse(facts, notes, "p", ["a", "b"]).join(people, "p"), "p")
