"""URL filters by host reputation; DataFrame functions only.

Rules label the pages they fit. For other pages the labelled outcomes of their host decide, shrunk through
beta-binomial priors: all pages -> suffix -> registered domain -> host. At each level the prior's mean is
the posterior mean of the level above; its strength is fitted to the spread of the shares at that level by
moments. A page is blocked if the lower bound of its host's share of bad pages is above a threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.base import ascii_lower, table
from tallyloom.llm.registry import query

#: (verdict, host, start of the path); the longest rule that fits wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A host is blocked if its share of bad pages is above THRESHOLD at Z standard deviations below the mean.
THRESHOLD, Z = 0.5, 1.64
#: Bounds of a fitted prior strength, in pages.
WEAKEST, STRONGEST = 2.0, 1000.0
LEVELS = ("suffix", "domain", "host")
#: Suffixes of two labels under which names are registered. Give a fuller list as a parameter.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "or.jp", "org.au", "org.uk")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for null or where `://` is missing."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return ascii_lower(part(1)), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits host and path; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def registered(host: Column, labels: int) -> Column:
    """The last `labels` labels of a host name."""
    return F.substring_index(host, ".", -labels)


def reputation(outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(host, bad, n, mean, sd) for every host of `outcomes` (host, bad, n); n may be 0.

    Hosts without labelled pages get the prior of their domain, and so on up to all pages. A suffix is the last
    label of a host or one of `suffixes`, its domain has one label more.
    """
    two = registered(F.col("host"), 2)
    paired = two.isin(list(suffixes))
    names = outcomes.withColumn("domain", F.when(paired, registered(F.col("host"), 3)).otherwise(two))
    names = names.withColumn("suffix", F.when(paired, two).otherwise(registered(F.col("host"), 1)))
    total = outcomes.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("b"), F.coalesce(F.sum("n"), F.lit(0)).alias("k"))
    above = total.select(((F.col("b") + 1) / (F.col("k") + 2)).alias("prior"), F.lit(1).alias("one"))
    keys: list[str] = []
    for level in LEVELS:
        keys = [*keys, level]
        own = names.withColumn("one", F.lit(1)).groupBy("one", *keys).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        own = own.join(above, ["one", *keys[:-1]])
        seen = F.col("n") > 0
        share = F.col("bad") / F.col("n")
        # Moments over the level: spread of shares around their priors against what chance alone would give.
        spread = own.filter(seen).agg(
            F.sum(F.col("n") * (share - F.col("prior")) * (share - F.col("prior"))).alias("ss"),
            F.sum(F.col("prior") * (1 - F.col("prior"))).alias("chance"),
            F.sum((F.col("n") - 1) * F.col("prior") * (1 - F.col("prior"))).alias("more"))
        # With rho = 1 / (strength + 1), the expected ss is chance + rho * more.
        rho = F.when(F.col("more") > 0, (F.col("ss") - F.col("chance")) / F.col("more")).otherwise(0.0)
        weakest, strongest = 1 / (WEAKEST + 1), 1 / (STRONGEST + 1)
        strength = spread.select((1 / F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(strongest)), F.lit(weakest)) - 1).alias("strength"), F.lit(1).alias("one"))
        own = own.join(strength, "one")
        own = own.withColumn("a", F.col("prior") * F.col("strength") + F.col("bad"))
        own = own.withColumn("ab", F.col("strength") + F.col("n")).withColumn("mean", F.col("a") / F.col("ab"))
        above = own.select("one", *keys, F.col("mean").alias("prior"))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("ab") + 1))
    return own.select("host", "bad", "n", "mean", sd.alias("sd"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, z: float = Z, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, share (posterior mean, null under a rule), bound (its lower bound).

    Labelled outcomes are the pages that a rule decides. One row per input row; repeated rows count each.
    A null url has an empty host and is judged like any host without labelled pages. Only page_id and url
    are read. An empty table gives an empty result.
    """
    host, path = url_parts(F.col("url"))
    x = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    x = x.withColumn("rule", name).withColumn("ruled", verdict)
    outcomes = x.groupBy("host").agg(F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("bad"),
                                     F.count("ruled").alias("n"))
    known = reputation(outcomes, suffixes).select("host", F.col("mean").alias("share"), F.greatest(F.lit(0.0), F.col("mean") - z * F.col("sd")).alias("bound"))
    out = x.join(known, "host")
    free = F.col("ruled").isNull()
    own = F.when(F.col("bound") > threshold, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
                      F.when(free, F.col("share")).alias("share"), F.when(free, F.col("bound")).alias("bound"))


def _level_sql(level: int) -> str:
    """DuckDB: posterior means of one level (its keys, bad, n, prior, strength, mean), from those of the level above."""
    keys = ", ".join(LEVELS[: level + 1])
    above = f"JOIN level{level - 1} AS above USING ({', '.join(LEVELS[:level])})" if level else "CROSS JOIN (SELECT (sum(bad) + 1) / (sum(n) + 2) AS mean FROM names) AS above"
    return f"""
  own{level} AS (SELECT {keys}, sum(own.bad) AS bad, sum(own.n) AS n, any_value(above.mean) AS prior FROM names AS own {above} GROUP BY {keys}),
  fit{level} AS (SELECT sum(n * (bad / n - prior) * (bad / n - prior)) AS ss, sum(prior * (1 - prior)) AS chance, sum((n - 1) * prior * (1 - prior)) AS more
                 FROM own{level} WHERE n > 0),
  rho{level} AS (SELECT 1 / least(greatest(coalesce(CASE WHEN more > 0 THEN (ss - chance) / more END, 0.0::DOUBLE), {1 / (STRONGEST + 1)!r}::DOUBLE), {1 / (WEAKEST + 1)!r}::DOUBLE) - 1 AS strength FROM fit{level}),
  level{level} AS (SELECT *, (prior * strength + bad) / (strength + n) AS mean FROM own{level} CROSS JOIN rho{level})"""


SQL = rf"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
  ruled AS (
  SELECT *, CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts),
  judged AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS said FROM ruled),
  names AS (SELECT host, CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({", ".join(map(repr, SUFFIXES))}) THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE string_split(host, '.')[-1] END AS suffix,
                   CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({", ".join(map(repr, SUFFIXES))}) THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS domain,
                   (count(*) FILTER (said = 'block'))::DOUBLE AS bad, count(said)::DOUBLE AS n FROM judged GROUP BY host),
  {", ".join(_level_sql(i) for i in range(len(LEVELS)))}
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN mean - {Z} * sqrt(mean * (1 - mean) / (strength + n + 1)) > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN level2 USING (host)
"""


@query("op7_url_filter", SQL)
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")
