"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

A rule is a host and a path prefix, with a verdict; it fits its host and all subdomains, for paths
that start with its own.  Distinct (host, path) pairs are expanded into expressions 'host suffix +
path prefix', only for those (labels of a suffix, length of a prefix) that rules have, so a long url
costs no more expressions than there are such shapes.  The shapes are a table (labels, all lengths)
that meets the pairs by the number of labels: the plan is the same for any rules.  Expressions meet the rules in an equi-join on
the first ``PREFIX_HEX`` hex digits of their SHA-256; the whole digest then confirms the rule.  Of
the confirmed rules the longest wins, then the longer host, then block before allow.  Verdicts go
back to the pages by (host, path).

The shapes are broadcast only if they are proven small, the rules only where Spark finds them under its
threshold; otherwise the joins shuffle, on pairs that were made distinct first, and skewed partitions
may be split.

Nulls and edges: a null url or one without '://' has an empty host and path, and only a rule with an
empty host could fit it; without a rule the verdict is ``DEFAULT``; a rule with a null host or path
fits nothing; repeated rules and pages change nothing; a rule given with both verdicts blocks; extra
columns of the pages are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import table
from airshed.operators.joins import bounded_broadcast

PREFIX_HEX = 8
DEFAULT = "allow"
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first '://' and the next '/', '?' or '#', A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to '?' or '#'."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.  ``rules``: host, path, verdict."""
    known = rules.filter("host is not null and path is not null").select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict") \
        .groupBy("rule_host", "rule_path").agg(F.max(F.col("verdict") == "block").alias("block"))
    text = F.concat("rule_host", "rule_path")
    # a rule's place in its text is part of what is hashed: 'a.b' + '/c' is no rule 'a' + '.b/c'
    mark = F.concat("rule_host", F.lit("\n"), "rule_path")
    known = known.select(
        F.substring(digest(mark), 1, PREFIX_HEX).alias("prefix"), digest(mark).alias("rule_digest"), text.alias("rule"), "block",
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.char_length("rule_path").alias("chars"),
        F.char_length("rule_host").alias("host_chars"))
    shapes, _ = bounded_broadcast(known.groupBy(F.col("labels").alias("n")).agg(F.sort_array(F.collect_set("chars")).alias("lengths")))

    judged = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    pairs = judged.select("host", "path").distinct()
    numbers = F.sequence(F.lit(1), F.size(F.split("host", r"\.")))
    expression = lambda c: digest(F.concat(F.expr("substring_index(host, '.', -n)"), F.lit("\n"), F.col("path").substr(F.lit(1), c)))
    fitting = F.filter("lengths", lambda c: c <= F.char_length("path"))
    found = pairs.withColumn("n", F.explode(numbers)).join(shapes, "n") \
        .select("host", "path", F.explode(F.transform(fitting, expression)).alias("digest")) \
        .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)) \
        .join(known, "prefix").filter(F.col("digest") == F.col("rule_digest"))
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        F.char_length("rule").alias("chars"), "host_chars", "block", "rule")).alias("b"))
    best = best.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("b.rule").alias("rule"),
                       F.when(F.col("b.block"), "block").otherwise("allow").alias("_verdict"))
    return judged.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left") \
        .select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("_verdict", F.lit(default)).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every url of ``pages``."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)


QUERIES = {"op2_url_filter": op2_url_filter}
ORACLE = {"op2_url_filter": rf"""
WITH p AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')
              ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
hits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY strlen(rule_host || rule_path) DESC) AS place
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, '{DEFAULT}') AS verdict
FROM p LEFT JOIN (SELECT * FROM hits WHERE place = 1) h ON p.page_id = h.page_id"""}
