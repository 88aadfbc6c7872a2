"""Operator 4, URL filters: allow and block rules, then empirical-Bayes host reputation.

A page's outcome is the quality label of the document that its url's path numbers (``/<language>/<doc_id>``).
Outcomes are counted per host and shrunk top-down through beta-binomial priors: the corpus is the prior of a
suffix, a suffix that of a registered domain, a domain that of a host. How strongly a level shrinks is fitted
by moments over all of its members. A host is blocked if the lower bound of its posterior share of bad pages
(mean less ``Z`` standard deviations of the posterior beta) is above ``MAX_BAD``. A rule, where one fits, decides before that.

The registered domain is the last two labels of a host, three if the last is a country's and the one before
a usual second level (``co.uk``); there is no public-suffix list here. An address of digits is its own domain.

Scale: outcomes are combined map-side into one row per host, so a host with a third of all pages is one
row; three numbers reach the driver. Pages meet the host table in one equi-join, whose hot hosts Spark's
skew join splits. Rules are part of the plan, at most ``MAX_RULES``. Html is never read.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, no rule and the verdict of the corpus
prior. Repeated rows are judged alike, label rows with NULL are left out, a doc_id with contradicting labels is bad.
The corpus itself starts from one bad page in ten, so without labels nothing is blocked. Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortsieve.llm.registry import query
from cohortsieve.llm.texts import ascii_lower, table
from cohortsieve.session import cut_lineage

MAX_BAD, Z, MAX_RULES = 0.3, 1.645, 1000
#: Usual second levels below a country's suffix (fixed values).
SECOND_LEVELS = ("ac", "co", "com", "edu", "gov", "net", "org")
LEVELS = ("suffix", "domain", "host")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query (fixed values).
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def with_url_parts(pages: DataFrame) -> DataFrame:
    """(page_id, host, path)"""
    after = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return pages.select("page_id", after.alias("after")).select(
        "page_id", ascii_lower(F.regexp_extract("after", r"^([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("after", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def fitting_rule(rules: tuple[Rule, ...]) -> Column:
    """(length, rule, verdict) of the longest rule that fits, else NULL."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = []
    for r in rules:
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        found.append(F.when(fits, F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"),
                                           F.lit(r.verdict).alias("verdict"))))
    return reduce(lambda a, b: F.when(b.isNotNull() & (a.isNull() | (a["size"] < b["size"])), b).otherwise(a), found)


def with_domains(hosts: DataFrame) -> DataFrame:
    """Adds the registered domain and the suffix of ``host``."""
    second = "|".join(SECOND_LEVELS)
    bare = F.regexp_replace("host", r"^.*@|:[0-9]*$", "")
    domain = F.regexp_extract(bare, rf"([^.]+\.(?:(?:{second})\.[a-z]{{2}}|[^.]+))$", 1)
    domain = F.when(bare.rlike(r"^[0-9.]*$") | (domain == ""), bare).otherwise(domain)
    return hosts.withColumn("domain", domain).withColumn(
        "suffix", F.when(F.col("domain").rlike(r"^[0-9.]*$"), "").otherwise(
            F.regexp_extract("domain", r"^[^.]*\.(.*)$", 1)))


def outcomes(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, bad): labelled pages and bad ones of each host with any."""
    known = (labels.filter("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg((F.min("quality") == 0).cast("long").alias("bad")))
    numbered = urls.select("host", F.expr(
        "try_cast(nullif(regexp_extract(path, '^/[a-z][a-z]/([0-9]+)', 1), '') as bigint)").alias("doc_id"))
    return (numbered.filter("doc_id is not null").join(known, "doc_id")
            .groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad")))


def _strength(level: DataFrame) -> float:
    """How many outcomes the prior of a level weighs, by moments over (n, bad, prior mean)."""
    even = "n * m * (1 - m)"
    r = level.selectExpr(f"sum(power(bad - n * m, 2) - {even}) as over", f"sum((n - 1) * {even}) as most").first()
    rho = 0.001 if not r["most"] else min(0.999, max(0.001, r["over"] / r["most"]))
    return 1 / rho - 1


def reputation(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n_labelled, n_bad, mean, bound) of every host of ``urls``."""
    counted = with_domains(cut_lineage(outcomes(urls, labels), "host-outcomes"))
    whole = counted.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    means, prior = {}, F.lit(((whole["bad"] or 0) + 1) / ((whole["n"] or 0) + 10))
    hosts = with_domains(urls.select("host").distinct())
    strength = 0.0
    for level in LEVELS:
        keys = LEVELS[:LEVELS.index(level) + 1]
        sums = counted.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        for k, m in means.items():
            sums = sums.join(m, k)
        strength = _strength(sums.withColumn("m", prior))
        mean = (strength * prior + F.col("bad")) / (strength + F.col("n"))
        if level == "host":
            break
        means = {level: sums.select(level, mean.alias(f"{level}_mean"))}
        hosts = hosts.join(means[level], level, "left")
        higher = prior
        hosts = hosts.withColumn(f"{level}_mean", F.coalesce(f"{level}_mean", higher))
        prior = F.col(f"{level}_mean")
    all_ = hosts.join(counted.select("host", "n", "bad"), "host", "left").fillna(0, ["n", "bad"])
    a, b = strength * prior + F.col("bad"), strength * (1 - prior) + F.col("n") - F.col("bad")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return all_.select("host", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"),
                       (a / (a + b)).alias("mean"), (a / (a + b) - Z * sd).alias("bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled, n_bad, mean, bound, one row per row of ``pages``."""
    urls = with_url_parts(pages)
    judged = urls.join(reputation(urls, labels), "host", "left").withColumn("hit", fitting_rule(rules))
    learnt = F.when(F.col("bound") > MAX_BAD, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                         F.coalesce("hit.verdict", learnt).alias("verdict"), "n_labelled", "n_bad", "mean", "bound")


def _strength_sql(name: str, source: str) -> str:
    return f"""{name} AS (SELECT 1 / (CASE WHEN coalesce(sum((n - 1) * n * m * (1 - m)), 0) = 0 THEN 0.001 ELSE
  least(0.999, greatest(0.001, sum(power(bad - n * m, 2) - n * m * (1 - m)) / sum((n - 1) * n * m * (1 - m)))) END) - 1 AS k FROM {source})"""


_SECOND = "|".join(SECOND_LEVELS)
SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
l AS (SELECT doc_id, CAST(min(quality) = 0 AS BIGINT) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
o AS (SELECT host, count(*) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM v JOIN l
  ON try_cast(nullif(regexp_extract(path, '^/[a-z][a-z]/([0-9]+)', 1), '') AS BIGINT) = doc_id GROUP BY host),
b AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM (SELECT DISTINCT host FROM v)),
d AS (SELECT host, CASE WHEN regexp_matches(bare, '^[0-9.]*$') OR regexp_extract(bare, '([^.]+\.(?:(?:{_SECOND})\.[a-z][a-z]|[^.]+))$', 1) = ''
  THEN bare ELSE regexp_extract(bare, '([^.]+\.(?:(?:{_SECOND})\.[a-z][a-z]|[^.]+))$', 1) END AS domain FROM b),
h AS (SELECT host, domain, CASE WHEN regexp_matches(domain, '^[0-9.]*$') THEN '' ELSE regexp_extract(domain, '^[^.]*\.(.*)$', 1) END AS suffix FROM d),
c AS (SELECT h.*, n, bad FROM h JOIN o USING (host)),
root AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 10) AS m FROM c),
s1 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM c, root GROUP BY suffix),
{_strength_sql("sk", "s1")},
sm AS (SELECT suffix, (k * m + bad) / (k + n) AS suffix_mean FROM s1, sk),
d1 AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(suffix_mean) AS m FROM c JOIN sm USING (suffix) GROUP BY suffix, domain),
{_strength_sql("dk", "d1")},
dm AS (SELECT domain, (k * m + bad) / (k + n) AS domain_mean FROM d1, dk),
h1 AS (SELECT c.*, domain_mean AS m FROM c JOIN dm USING (domain)),
{_strength_sql("hk", "h1")},
p AS (SELECT h.host, coalesce(o.n, 0) AS n, coalesce(o.bad, 0) AS bad, k, coalesce(domain_mean, suffix_mean, root.m) AS m
  FROM h LEFT JOIN o USING (host) LEFT JOIN dm USING (domain) LEFT JOIN sm USING (suffix), hk, root),
q AS (SELECT host, n, bad, k * m + bad AS a, k * (1 - m) + n - bad AS b FROM p),
r AS (SELECT host, n, bad, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM q),
w AS (SELECT v.*, n, bad, bound, CASE
  WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM v JOIN r USING (host))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN bound > {MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict, CAST(n AS BIGINT) AS n_labelled, CAST(bad AS BIGINT) AS n_bad FROM w
"""


@query("op4_url_filter", SQL)
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))
    return judged.drop("mean", "bound")
