"""URL rules by a sort-merge range join, in built-in functions only.

A rule (host, path) is an interval of keys (reversed host, path): all paths that start with
its own. A url is placed once under each of its host's suffixes that a rule could name, so
subdomains need no search. Rules and urls are sorted together; each rule carries the stack
of rules that enclose it (itself on top), and the sweep keeps the stack of the last rule
passed. For a url, rules on top that have ended are popped; the next one is the innermost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.llm.common import join_keyed, materialize

BUCKET_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and the path behind it; else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule with the rules of its host whose path starts its own, longest first."""
    outer = rules.select("host", F.col("path").alias("outer"), F.col("verdict").alias("outer_verdict"))
    starts = F.transform(
        F.sequence(F.lit(0), F.char_length("path")), lambda n: F.left(F.col("path"), n)
    )
    pairs = rules.select("host", "path", F.explode(starts).alias("outer")).join(outer, ["host", "outer"])
    level = F.struct(F.char_length("outer").alias("n"), F.col("outer").alias("path"), F.col("outer_verdict").alias("verdict"))
    return pairs.groupBy("host", "path").agg(F.sort_array(F.collect_list(level), asc=False).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (page_id, url).

    A rule (host, path, verdict) fits its host and all subdomains if the url's path starts
    with the rule's; the one with most characters in host and path wins, then the longer
    host. If two rules have the same host and path, ``block`` wins. No rule: null and
    ``default``. Urls that are null or have no ``://`` get empty host and path. Rules with a
    null or empty host fit nothing; a null path is an empty one. Repeated rows each give a
    row; an empty table of pages gives an empty result, one of rules only the default.

    Each distinct (host, path) is judged once. The sweep runs in buckets drawn by hash, so a
    hot host is spread, as are the rows of a hot url at the end; every bucket gets all rules, and there are at most as many buckets
    as keep these copies no more than the urls.
    """
    url_host, url_path = url_host_path(F.col("url"))
    placed = pages.select("page_id", url_host.alias("host"), url_path.alias("path"))
    known = (
        rules.where("host != ''")
        .select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    stacks = materialize(_stacks(known), "rules")
    labels = F.size(F.split("host", r"\."))
    n_rules, deepest = stacks.agg(F.count(F.lit(1)), F.coalesce(F.max(labels), F.lit(0))).first()
    urls = materialize(placed.select("host", "path").distinct(), "urls")
    n_urls = urls.count()
    wanted = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_urls // BUCKET_ROWS)
    buckets = max(1, min(wanted, n_urls // max(n_rules, 1)))

    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(deepest, 1)))),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    bucket = F.pmod(F.xxhash64("host", "path"), F.lit(buckets)).cast("int")
    events = urls.select("host", "path", F.explode(suffixes).alias("level"), bucket.alias("bucket")).select(
        "bucket", _reversed(F.col("level")).alias("key"), "path", F.lit(1).alias("is_url"), "host",
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
        F.lit(None).cast("string").alias("rule_host"),
    )
    starts = stacks.select(
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
        _reversed(F.col("host")).alias("key"), "path", F.lit(0).alias("is_url"),
        F.lit(None).cast("string").alias("host"), "stack", F.col("host").alias("rule_host"),
    )
    sweep = (
        Window.partitionBy("bucket")
        .orderBy("key", "path", "is_url")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    active = F.when(F.col("is_url") == 0, F.struct("key", "rule_host", "stack"))
    swept = starts.unionByName(events).withColumn("active", F.last(active, ignorenulls=True).over(sweep))
    innermost = F.get(F.filter("active.stack", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    hits = (
        swept.where((F.col("is_url") == 1) & (F.col("active.key") == F.col("key")))
        .select("host", "path", F.col("active.rule_host").alias("rule_host"), innermost.alias("r"))
        .where(F.col("r").isNotNull())
    )
    size = F.char_length("rule_host") + F.col("r.n")
    best = F.max(
        F.struct(size.alias("n"), F.char_length("rule_host").alias("h"),
                 F.concat("rule_host", "r.path").alias("rule"), F.col("r.verdict").alias("verdict"))
    )
    won = hits.groupBy("host", "path").agg(best.alias("best"))
    return join_keyed(placed, won, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


#: The rules of the contract.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

ORACLE = r"""
WITH r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
a AS (SELECT page_id, row_number() OVER () AS k,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, k, rest, regexp_extract(rest, '^[^/?#]*') AS h0 FROM a),
c AS (SELECT page_id, k, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
      FROM c JOIN r ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM c LEFT JOIN d USING (k)
"""
