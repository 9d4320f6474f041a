"""Operator 9: URL filters (DataFrame functions only).

Every distinct URL is expanded into host-suffix x directory-prefix expressions
("example.com/en/" for host ``www.example.com``, path ``/en/7``). Expressions
and rules meet in an equi-join on the first four bytes of their SHA-256; the
full digest and the rule's whole path are then confirmed, and the longest rule
wins. Expansion is never deeper than the deepest rule, so its size follows the
rule table, not the URL.

A rule (host, path, verdict) fits its host and all subdomains when the URL's
path starts with the rule's path. Longest means host plus path in characters,
then the longer host, then ``block`` before ``allow``. Rules with a null host,
path or verdict are ignored; an empty rule table lets every URL through.

Defined results: a null URL, or one without ``://``, has empty host and path and
gets the default verdict; repeated rows (and repeated page ids) each get their own
row; columns besides the id and the URL are ignored; an empty table gives no
rows. Work is done once per distinct URL, so a URL that fills a third of the table costs
one expansion; its verdict returns by a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import take_columns

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORT_HEX = 8  # four bytes of the digest
DEFAULT_VERDICT = "allow"

# The rules of the registered query.
DEMO_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` with A-Z lower-cased, path up to ``?`` or ``#``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    blank = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), blank), F.coalesce(path, blank)


def _directory(path: Column) -> Column:
    """The part of a path up to and including its last slash."""
    return F.regexp_extract(path, "^(?s)(.*/)?", 1)


def _digested(df: DataFrame, expression: Column) -> DataFrame:
    digest = F.sha2(expression, 256)
    return df.withColumn("digest", digest).withColumn("short", F.left("digest", F.lit(SHORT_HEX)))


def expand(urls: DataFrame, labels: int, slashes: int) -> DataFrame:
    """(url, path, digest, short): one row per host suffix of at most ``labels`` labels and
    directory prefix of at most ``slashes`` slashes."""
    parts = F.split("host", "\\.")
    take = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(
        F.sequence(F.lit(1), take), lambda k: F.array_join(F.slice(parts, -k, k), ".")
    )
    steps = F.split("path", "/")  # a path with m slashes has m + 1 steps
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(steps) - 1, F.lit(slashes))),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, 1, k), "/"), F.lit("/"))),
    )
    rows = urls.select("url", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    rows = rows.select("url", "path", "suffix", F.explode("prefixes").alias("prefix"))
    return _digested(rows, F.concat("suffix", "prefix")).select("url", "path", "digest", "short")


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``."""
    rows = take_columns(pages, {id_col: "bigint", url_col: "string"})
    rows = rows.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"))
    r = take_columns(rules, {"host": "string", "path": "string", "verdict": "string"}).dropna()
    r = r.select(
        F.concat("host", "path").alias("rule"),
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).distinct()
    r = _digested(r, F.concat("rule_host", _directory(F.col("rule_path")))).withColumnRenamed("digest", "rule_digest")
    # Two integers: how deep any rule goes.
    deep = r.agg(
        F.max(F.size(F.split("rule_host", "\\."))).alias("labels"),
        F.max(F.size(F.split("rule_path", "/")) - 1).alias("slashes"),
    ).first()
    labels, slashes = int(deep["labels"] or 1), int(deep["slashes"] or 0)

    host, path = split_url(F.col("url"))
    urls = rows.select("url").where(F.col("url").isNotNull()).distinct()
    urls = urls.select("url", host.alias("host"), path.alias("path"))
    hits = expand(urls, labels, slashes).join(r, "short")
    hits = hits.where((F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path")))
    order = F.struct(
        F.length("rule").alias("a"),
        F.length("rule_host").alias("b"),
        (F.col("rule_verdict") == "block").alias("c"),
        F.col("rule").alias("d"),
        F.col("rule_verdict").alias("e"),
    )
    best = hits.groupBy("url").agg(F.max(order).alias("best"))
    best = best.select("url", F.col("best.d").alias("rule"), F.col("best.e").alias("verdict"))
    return rows.join(best, "url", "left").select(
        id_col,
        host.alias("host"),
        path.alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )


def demo_rules(spark) -> DataFrame:
    return spark.createDataFrame(DEMO_RULES, "host string, path string, verdict string")
