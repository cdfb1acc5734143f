"""URL filter: host-suffix and path-prefix expressions against a rule list.

A rule is (host, path, verdict).  It fits its host and all subdomains if the
url's path starts with the rule's path; of the rules that fit, the longest
host + path wins, then the longer host, then block.

Each url is expanded into the expressions ``host suffix + path prefix``.  Path
prefixes are taken only at the lengths that rule paths have (a small set read
from the rules), host suffixes at every label.  Expressions and rules meet in
an equi-join on the first four bytes of their SHA-256; the full digests are
compared after it.  Expression rows of one url are reduced to its best rule by
a grouped maximum with map-side combine.  Urls are first reduced to distinct
(host, path) pairs, so a url or host that is in a third of all rows is expanded
once.

The rule side is small next to the urls; it is not broadcast by force: Spark
broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both
sides above.

Cases: a null url, or one without ``://``, has empty host and path and no rule;
no rule: the default verdict (allow); empty tables give empty results; rules
with null parts are ignored; equal rules count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed values of the contract: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def url_host(url: Column) -> Column:
    rest = F.coalesce(F.substring(url, F.locate("://", url) + F.lit(3), F.length(url)), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.when(F.locate("://", url) > 0, F.translate(host, UPPER, LOWER)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.coalesce(F.substring(url, F.locate("://", url) + F.lit(3), F.length(url)), F.lit(""))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _digests(host: Column, path: Column) -> tuple[Column, Column]:
    full = F.sha2(F.concat_ws("\n", host, path), 256)
    return F.substring(full, 1, 8).alias("short"), full.alias("full")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (host + path of the winning rule) and
    verdict; underscores in front of names the input has."""
    spark = pages.sparkSession
    names = {n: free_name(pages.columns, n) for n in ("host", "path", "rule", "verdict")}
    clean = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")).dropna()
    clean = clean.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))  # block > allow
    hashed = staged(clean.select("*", *_digests(F.col("r_host"), F.col("r_path"))), "url-rules")
    # at most as many integers as the longest rule path has characters
    lengths = sorted(r.cut for r in hashed.select(F.length("r_path").alias("cut")).distinct().collect())
    cuts = F.array(*map(F.lit, lengths)).cast("array<int>")
    # and of labels as the longest rule host has: a host makes no other suffixes
    dots = lambda host: F.length(host) - F.length(F.replace(host, F.lit(".")))
    depths = sorted(r.depth for r in hashed.select((dots(F.col("r_host")) + 1).alias("depth")).distinct().collect())

    parts = pages.withColumns({names["host"]: url_host(F.col(f"`{url}`")), names["path"]: url_path(F.col(f"`{url}`"))})
    keys = parts.select(F.col(names["host"]).alias("host"), F.col(names["path"]).alias("path")).distinct()
    suffix = [F.when(dots(F.col("host")) + 1 >= k, F.substring_index("host", ".", -k)) for k in depths]
    wide = keys.select("host", "path", F.explode(F.array(*suffix).cast("array<string>")).alias("e_host")).filter("e_host IS NOT NULL")
    wide = wide.withColumn("cut", F.explode(cuts)).filter(F.col("cut") <= F.length("path"))
    wide = wide.withColumn("e_path", F.expr("substring(path, 1, cut)"))
    wide = wide.select("host", "path", *_digests(F.col("e_host"), F.col("e_path")))
    best = (
        wide.join(hashed.withColumnRenamed("full", "r_full"), "short")
        .filter(F.col("full") == F.col("r_full"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"), "r_verdict", "r_host", "r_path"
                )
            ).alias("best")
        )
        .select(
            F.col("host").alias("b_host"),
            F.col("path").alias("b_path"),
            F.concat("best.r_host", "best.r_path").alias("b_rule"),
            F.col("best.r_verdict").alias("b_verdict"),
        )
    )
    best = staged(best, "url-best")
    b_host, b_path, b_rule, b_verdict = (free_name(parts.columns, n) for n in best.columns)
    judged = parts.join(best.toDF(b_host, b_path, b_rule, b_verdict), (F.col(names["host"]) == F.col(b_host)) & (F.col(names["path"]) == F.col(b_path)), "left")
    return judged.select(
        *[F.col(f"`{c}`") for c in parts.columns],
        F.col(b_rule).alias(names["rule"]),
        F.coalesce(F.col(b_verdict), F.lit(default)).alias(names["verdict"]),
    )


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, default_rules(spark)).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = """
WITH rules(r_host, r_path, r_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT page_id, r_host || r_path AS rule, r_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC, length(r_host) DESC, r_verdict DESC) AS k
  FROM parts, rules
  WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT parts.page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON fits.page_id = parts.page_id AND fits.k = 1
"""
