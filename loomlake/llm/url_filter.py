"""URL filters by host-suffix and path-prefix expressions.

Every rule is one expression ``host + path``. A URL is expanded into the suffixes of its host, which are equi-joined with the
rules' hosts; a suffix that is some rule's host is expanded into the path prefixes of the lengths that this host's rules
have, and those expressions are equi-joined with the rules. Both joins are on the first eight hex digits of
SHA-256, confirmed on the full digest; the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.common import ascii_lower, read

#: Hex digits of the digest that are joined on.
PREFIX_DIGITS = 8
#: Parts that the pages of one host and path are dealt to in the join with their verdict.
SALTS = 16
DEFAULT_VERDICT = "allow"
#: Fixed values of the query's contract: host, path, verdict.
CONTRACT_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule list as the DataFrame that ``filter_urls`` takes."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _digested(df: DataFrame, of: str, prefix: str = "") -> DataFrame:
    digest = F.sha2(of, 256)
    return df.withColumns({f"{prefix}digest": digest, f"{prefix}key": F.substring(digest, 1, PREFIX_DIGITS)})


def _prepared(rules: DataFrame) -> DataFrame:
    """One row a rule with its digest; of rules with equal host and path a block stands."""
    host, path = ascii_lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    ruled = rules.where(F.col("host").isNotNull() & F.col("verdict").isin("allow", "block")).select(host.alias("rule_host"), F.concat(host, path).alias("rule"), F.length(path).alias("chars"), "verdict")
    return _digested(ruled.groupBy("rule_host", "rule", "chars").agg(F.max("verdict").alias("rule_verdict")), "rule", "rule_")


def filter_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """Judge each row's URL: (page_id, host, path, rule, verdict).

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits its host and all
    subdomains if the URL's path starts with the rule's path; the longest rule (host and path
    together) wins; of equal rules a block wins, rules without a host are left out. Rows are kept as they come: repeated rows and null
    ids each give a row; a null URL or one without ``://`` has empty host and path, which no rule
    fits; an empty table gives no rows. Other columns of ``pages`` are not read.

    Expressions are made once for each distinct (host, head of the path), so that a host
    with a third of all pages is expanded a few times only; the pages meet their verdict in SALTS parts. Only the length of the longest rule's path
    reaches the driver. Spark picks a broadcast of the rules by their measured size, else a shuffle join.
    """
    ruled = _prepared(rules)
    host, path = url_parts(F.col(url_column))
    urls = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    longest = ruled.agg(F.max("chars")).first()[0]
    if longest is None:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    urls = urls.withColumn("head", F.substring("path", 1, longest)).withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)))
    parts = urls.where(F.col("host") != "").select("host", "head").distinct()
    labels = F.split("host", r"\.")
    suffixes = _digested(parts.select("host", "head", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, -n, n), "."))).alias("suffix")), "suffix")
    hosts = _digested(ruled.groupBy("rule_host").agg(F.collect_set("chars").alias("lengths")), "rule_host", "host_")
    met = suffixes.join(hosts, F.col("key") == F.col("host_key")).where(F.col("digest") == F.col("host_digest")).select("host", "head", "suffix", F.explode("lengths").alias("k"))
    expressions = _digested(met.where(F.length("head") >= F.col("k")).select("host", "head", F.concat("suffix", F.substring(F.col("head"), F.lit(1), F.col("k"))).alias("expression")), "expression")
    fits = (
        expressions.join(ruled, F.col("key") == F.col("rule_key"))
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "head")
        .agg(F.max(F.struct(F.length("rule").alias("length"), F.length("rule_host"), "rule", "rule_verdict")).alias("best"))
    )
    fits = fits.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return urls.join(fits, ["host", "head", "salt"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), rule_table(spark, CONTRACT_RULES))


ORACLE = """
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
  ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
best AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) d JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
"""
