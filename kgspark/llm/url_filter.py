"""URL filter lists: host-suffix and path-prefix expressions, short hash prefixes, full digests.

A rule names a host and a path.  It fits its host and all subdomains, if the
URL's path starts with the rule's; of the rules that fit, the longest (host and path
together) wins, then block before allow.  Each distinct (host, path) is expanded
into every suffix of its host by whole labels, as deep as the rules go, with each
path prefix of a length that some rule has.  Expressions and rules meet in an
equi-join on the first 32 bits of their SHA-256 digests; the full digests confirm.

Defined results: url null or without ``://``: host and path empty, no rule, the
default verdict.  Rows keep their number and their id, repeated or null ids too; an
empty table gives an empty table, and an empty rule list decides nothing.  Further
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BROADCAST = 5_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host, A-Z lower-cased, and the path up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    whole = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(whole, r"(?s)^([^/]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(whole, r"(?s)^[^/]*(.*)$", 1)


def rules_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(r_host, r_path, r_verdict) of (verdict, host, path)."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], "r_host string, r_path string, r_verdict string")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` under ``rules`` (r_host, r_path, r_verdict)."""
    rules = rules.select("r_host", "r_path", "r_verdict", F.sha2(F.concat("r_host", F.lit("\0"), "r_path").cast("binary"), 256).alias("r_digest"))
    shape = rules.agg(F.max(F.size(F.split("r_host", "\\."))).alias("labels"), F.collect_set(F.length("r_path")).alias("lengths"), F.count("*").alias("n")).first()
    url = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    url = url.select("page_id", host.alias("host"), path.alias("path"))
    labels, lengths = shape["labels"] or 1, sorted(shape["lengths"])
    parts = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    distinct = url.filter("host <> ''").select("host", "path").distinct()
    each = distinct.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    each = each.select("host", "path", "suffix", F.explode(F.filter("prefixes", lambda p: p.isNotNull())).alias("prefix"))
    each = each.withColumn("digest", F.sha2(F.concat("suffix", F.lit("\0"), "prefix").cast("binary"), 256)).withColumn("short", F.substring("digest", 1, 8))
    short = rules.withColumn("short", F.substring("r_digest", 1, 8))
    met = each.join(F.broadcast(short) if shape["n"] <= MAX_BROADCAST else short, "short").filter("digest = r_digest and suffix = r_host and prefix = r_path")
    order = F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_path").alias("p"), (F.col("r_verdict") == "block").alias("b"))
    best = met.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "r_verdict"), order).alias("best"))
    return url.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"))


def oracle_sql(rules: Sequence[tuple[str, str, str]], default: str = "allow") -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for v, h, p in rules)
    return f"""
WITH r(r_host, r_path, r_verdict) AS (VALUES {values}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN split_part(split_part(substr(url, strpos(url, '://') + 3), '?', 1), '#', 1) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, lower(split_part(coalesce(rest, ''), '/', 1)) AS host, substr(coalesce(rest, ''), length(split_part(coalesce(rest, ''), '/', 1)) + 1) AS path FROM u),
m AS (SELECT h.*, r.*, row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) + length(r_path) DESC NULLS LAST, length(r_path) DESC) AS k
      FROM h LEFT JOIN r ON (host = r_host OR host LIKE '%.' || r_host) AND starts_with(path, r_path))
SELECT page_id, host, path, r_host || r_path AS rule, coalesce(r_verdict, '{default}') AS verdict FROM m WHERE k = 1"""
