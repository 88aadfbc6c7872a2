"""Operator 2, personal data: base patterns, and boosted trees over high-recall candidates.

Generators propose spans, overlapping ones too: the base patterns themselves, and variants that the base grammar leaves
out (spelt-out or bracketed "at" and "dot", other separators in card numbers, phone numbers without plus,
bracketed and long IP addresses). Each candidate gets features of its normalised format (groups, lengths) and of its context (neighbouring characters, telling words before it). Gradient-boosted trees
are fitted on candidates in base grammar, whose labels are the outcome of the base checks, as no labelled spans exist; what they learn
carries over to variants through the normalised form. The checks are the label, so neither they nor the number of digits, which decides them for phones, are
features. A threshold per kind is calibrated on held-out candidates for ``PRECISION``; variants that pass the checks and are at
or above it are added where they overlap no base span, the likeliest first. Base spans always stay.

Scale: everything is built in; the trees are a Column expression, so no text or document is shuffled. The fit shuffles one row of numbers per
distinct content (span and context) and task. Trees take at most ``MAX_FIT`` distinct contents, as many of each kind and label, those with the
smallest hash; thresholds rest on the counts of all held-out candidates, grouped by features.

Defined cases: a NULL or empty text has no spans. Texts are read whole; patterns are possessive, so no text makes them
backtrack at length. Repeated rows are judged alike, an empty table gives no rows, further columns are not read. If the
candidates have labels of one kind only, no spans are added.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.texts import let, table, text_of
from cohortsieve.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
MAX_FIT, PRECISION, TREES, DEPTH = 20_000, 0.95, 12, 3
CONTEXT = 24
#: Base patterns. Possessive where that cannot change a match; a match begins where its run does or where the last one ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Top-level domains that make an unbracketed "a at b dot c" an address (fixed values).
_TOP = "com|org|net|edu|gov|info|io|de|fr|es|uk|example"
_AT = (r"(?:\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?"
       r"|\x20(?:at|AT)\x20(?=[A-Za-z0-9-]++(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]++)*?\x20(?:dot|DOT)\x20(?:" + _TOP + r")(?![A-Za-z0-9])))")
_DOT = r"(?:\.|\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20)"
#: Variants outside the base grammar.
VARIANTS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++" + _AT + r"[A-Za-z0-9-]++(?:" + _DOT + r"[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])"
          r"|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z.])[0-9]{4}[./_ –][0-9]{4}[./_ –][0-9]{4}[./_ –][0-9]{2,7}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:00[1-9][0-9]?[\x20.-])?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])",
}
#: Characters without which no span of the kind exists; other texts skip the patterns.
NEEDS = {"email": "(?i)@|[\\[({<]\\x20?at|\\x20at\\x20[a-z0-9-]+\\x20?[\\x20\\[({<]\\x20?dot", "ip": r"[0-9][.\[(]|:[0-9A-Fa-f]{1,4}:",
         "card": r"[0-9]", "phone": r"[0-9][\x20().0-9-]+[0-9]"}
TELLING = {"email": "mail|contact|write|reach", "ip": r"\bip\b|host|server|addr|login", "card": "card|visa|credit|pay|account",
           "phone": "tel|phone|call|mobile|fax|whatsapp"}
FEATURES = ("kind", "n_chars", "n_groups", "glued_before", "glued_after", "telling", "quoted", "head", "tail")


def _spans(body: Column, kind: str, pattern: str, plain: bool) -> Column:
    """(kind, start, end, raw, plain, before, after) of each match; places from the gaps between matches."""
    def placed(found: Column) -> Column:
        gaps = F.split(body, pattern, -1)
        ends = F.aggregate(
            F.zip_with(F.transform(found, F.length), F.transform(gaps, F.length), lambda m, g: F.struct(g.alias("g"), m.alias("m"))),
            F.lit([0]).cast("array<int>"),
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["g"] + F.coalesce(x["m"], F.lit(0)))))
        return let(ends, lambda e: F.transform(found, lambda m, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            (e[i + 1] - F.length(m)).alias("start"), e[i + 1].alias("end"), m.alias("raw"), F.lit(plain).alias("plain"),
            F.expr("''").alias("before"), F.expr("''").alias("after"))))

    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int,raw:string,plain:boolean,before:string,after:string>>)")
    found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    return F.when(body.rlike(NEEDS[kind]), let(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(none))).otherwise(none)


def candidates(body: Column) -> Column:
    """All candidate spans of a text, with the characters around them."""
    all_ = F.concat(*[_spans(body, k, p[k], p is BASE) for p in (BASE, VARIANTS) for k in KINDS])
    return F.transform(all_, lambda c: c.withField(
        "before", F.substring(body, F.greatest(c["start"] - CONTEXT + 1, F.lit(1)), F.least(c["start"], F.lit(CONTEXT)))).withField(
        "after", F.substring(body, c["end"] + 1, F.lit(1))))


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits, doubled at every second place from the right, sum to a multiple of ten."""
    d = F.split(F.reverse(digits), "")
    total = F.aggregate(F.transform(d, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        (x.cast("int") * 2) % 10 + F.floor(x.cast("int") / 5).cast("int"))), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def checked(c: Column) -> Column:
    """Whether the normalised span passes the checks of its kind."""
    digits = _digits(c["raw"])
    n = F.length(digits)
    parts = F.split(F.regexp_replace(c["raw"], r"[^0-9]+", "."), r"\.")
    octets = F.forall(parts, lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(r"^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (F.when(c["kind"] == 0, F.lit(True))
            .when(c["kind"] == 1, c["raw"].contains(":") | octets)
            .when(c["kind"] == 2, n.between(14, 19) & luhn(digits))
            .otherwise(n.between(10, 15)))


def features(c: Column) -> Column:
    """Numbers that describe a candidate's normalised format and its context."""
    number = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    shown = F.regexp_replace(F.regexp_replace(c["raw"], _AT, "@"), _DOT, ".")
    telling = reduce(lambda a, k: a.when(c["kind"] == KINDS.index(k), F.lower(c["before"]).rlike(TELLING[k])), KINDS[1:],
                     F.when(c["kind"] == 0, F.lower(c["before"]).rlike(TELLING["email"])))
    values = {
        "kind": c["kind"], "n_chars": F.length(shown),
        "n_groups": F.size(F.split(shown, "[^0-9A-Za-z]+")),
        "glued_before": c["before"].rlike("[0-9A-Za-z]$"), "glued_after": c["after"].rlike("[0-9A-Za-z]"), "telling": telling,
        "quoted": c["before"].rlike("[\"'=]\\x20?$"), "head": F.length(F.regexp_extract(shown, "^[^@]*", 0)),
        "tail": F.length(F.regexp_extract(shown, "[^.]*$", 0))}
    return F.struct(*[number(values[f]).alias(f) for f in FEATURES])


@dataclass(frozen=True)
class SpanModel:
    trees: list[tuple[float, str]] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def probability(self, x: Column) -> Column:
        """The boosted trees, as one expression over a struct of features."""
        margin = reduce(lambda a, b: a + b, [F.lit(w) * _tree(t, x) for w, t in self.trees], F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))


def _tree(text: str, x: Column) -> Column:
    """A tree, as Spark prints it, as nested conditions."""
    lines = iter(line.strip() for line in text.splitlines() if line.strip())

    def node() -> Column:
        line = next(lines)
        if line.startswith("Predict:"):
            return F.lit(float(line.split(":")[1]))
        feature, sign, value = re.match(r"If \(feature (\d+) (<=|in) (.+)\)", line).groups()
        assert sign == "<=", line
        low = node()
        next(lines)
        return F.when(x[FEATURES[int(feature)]] <= float(value), low).otherwise(node())

    return node()


def fit(docs: DataFrame) -> SpanModel:
    """Trees and thresholds from candidates of ``docs`` in base grammar."""
    found = docs.select(F.explode(F.filter(candidates(text_of()), lambda c: c["plain"])).alias("c"))
    rows = found.select(features(F.col("c")).alias("x"), checked(F.col("c")).cast("double").alias("label"),
                        F.xxhash64("c.raw", "c.before").alias("h"))
    # One row per content, however often it is copied.
    contents = cut_lineage(rows.groupBy("x", "label", "h").agg(F.count("*").alias("n")).select("x.*", "label", "h", "n"), "span-contents")
    held_out = F.pmod("h", F.lit(5)) == 0
    # The least hashes of each kind and label; one limit each, so that no task holds a kind.
    trained = [contents.filter(~held_out & (F.col("kind") == i) & (F.col("label") == label)).orderBy("h").limit(MAX_FIT // (2 * len(KINDS)))
               for i in range(len(KINDS)) for label in (0.0, 1.0)]
    sample = cut_lineage(reduce(DataFrame.unionAll, trained).drop("n"), "span-sample")
    two = sample.agg(F.min("label"), F.max("label")).first()
    if two[0] == two[1]:
        return SpanModel()
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, minInstancesPerNode=10, checkpointInterval=-1)
    model = gbt.fit(ready)
    trees = re.split(r"Tree \d+ \(weight ([-\d.eE]+)\):", model.toDebugString)[1:]
    boosted = SpanModel([(float(w), t) for w, t in zip(trees[::2], trees[1::2])])
    groups = contents.filter(held_out).groupBy(*FEATURES).agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("good"))
    scored = (groups.select("kind", "n", "good", F.round(boosted.probability(F.struct(*FEATURES)), 6).alias("p"))
              .groupBy("kind", "p").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect())
    thresholds = {k: cut_for([(r["p"], r["n"], r["good"]) for r in scored if r["kind"] == i]) for i, k in enumerate(KINDS)}
    return SpanModel(boosted.trees, thresholds)


def cut_for(scored: list[tuple[float, float, float]]) -> float:
    """The lowest probability from which on at least ``PRECISION`` of the held-out candidates are right.

    It lies midway to the next lower candidate, and at most at 0.5 if there is none.
    """
    best, n, good = math.inf, 0.0, 0.0
    ordered = sorted(scored, reverse=True)
    for (p, count, right), lower in zip(ordered, [*(x[0] for x in ordered[1:]), None]):
        n, good = n + count, good + right
        if good >= PRECISION * n:
            best = min(p, 0.5) if lower is None else (p + lower) / 2
    return best


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def find_spans(docs: DataFrame, model: SpanModel) -> DataFrame:
    """doc_id, text, and the sorted arrays ``base`` and ``all`` of (start, kind, end) per row of ``docs``."""
    df = docs.select("doc_id", text_of().alias("text")).withColumn("c", candidates(F.col("text")))
    short = lambda xs: F.sort_array(F.transform(xs, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    df = df.withColumn("base", short(F.filter("c", lambda c: c["plain"] & checked(c))))
    if not model.trees:
        return df.select("doc_id", "text", "base", F.col("base").alias("all"))
    free = F.filter("c", lambda c: ~c["plain"] & checked(c) & ~F.exists("base", lambda b: _overlap(b, c)))
    scored = F.transform(free, lambda c: F.struct(
        model.probability(features(c)).alias("p"), c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    df = df.withColumn("scored", F.when(F.size(free) > 0, scored).otherwise(F.expr(
        "cast(array() as array<struct<p:double,start:int,kind:int,end:int>>)")))
    limits = F.array(*[F.lit(float(model.thresholds.get(k, math.inf))) for k in KINDS])
    df = df.withColumn("likely", F.filter("scored", lambda c: c["p"] >= limits[c["kind"]]))
    beaten = lambda c: F.exists("likely", lambda o: _overlap(o, c) & (
        (o["p"] > c["p"]) | ((o["p"] == c["p"]) & (F.struct(o["start"], o["kind"]) < F.struct(c["start"], c["kind"])))))
    added = F.filter("likely", lambda c: ~beaten(c))
    return df.select("doc_id", "text", "base", F.sort_array(F.concat("base", F.transform(added, lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))).alias("all"))


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = find_spans(docs, fit(docs))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("all").alias("spans"),
                        (F.size("all") - F.size("base")).cast("long").alias("n_added"))
