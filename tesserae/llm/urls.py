"""URL filter by host-suffix and path-prefix expressions and short hash prefixes.

Only DataFrame functions: each URL is expanded into the expressions ``host suffix + path prefix``
that could equal a rule, their SHA-256 is cut to a short prefix for the equi-join, and a row counts
only if the full digest agrees.  The longest fitting rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = 8  # hex digits of the digest that the join compares
BROADCAST_RULES = 200_000  # a rule list up to this many rows is broadcast (about 30 MB); a longer one is shuffled
DEFAULT = "allow"  # the verdict of a URL that no rule fits: a rule list names what to act on

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``; other columns are not read.

    A rule (host, path) fits its host and all subdomains where the URL's path starts with the rule's;
    the longest (host and path together) wins, at equal length ``block`` wins.  Rows without a
    fitting rule, null URLs included, get ``default`` and a null rule.  Repeated rows stay repeated.
    An empty rule table gives ``default`` for all.  Expansion is bounded by the rules: as many host
    labels as their longest host has, and one prefix for each length that their paths have.
    """
    rules = rules.where("host is not null and path is not null")
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))), F.collect_set(F.length("path"))).first()
    labels, lengths = max(shape[0] or 1, 1), sorted(shape[1] or [])
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    parts = F.split("host", r"\.")
    tail = F.slice(parts, F.greatest(F.size(parts) - F.lit(labels - 1), F.lit(1)), F.lit(labels))
    urls = urls.withColumn("tail", tail)
    suffixes = F.transform(F.sequence(F.lit(1), F.size("tail")), lambda i: F.array_join(F.slice(F.col("tail"), i, F.size("tail")), "."))
    lens = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    urls = urls.withColumn("suffixes", suffixes).withColumn("lens", lens)
    expr = F.flatten(F.transform("suffixes", lambda s: F.transform("lens", lambda n: F.concat(s, F.substring(F.col("path"), F.lit(1), n)))))
    wide = urls.select("row", "id", "host", "path", F.explode_outer(expr).alias("expr"))
    digest = F.sha2(F.col("expr").cast("binary"), 256)
    # a URL without an expression gets a key of its own, which no prefix equals, so these rows are spread
    wide = wide.withColumn("digest", digest).withColumn("short", F.coalesce(F.substring("digest", 1, PREFIX), F.concat(F.lit("-"), F.col("row").cast("string"))))
    known = rules.select(F.concat("host", "path").alias("rule"), F.col("verdict").alias("v"))
    known = known.groupBy("rule").agg(F.max(F.struct(F.expr("v = 'block'").alias("block"), "v")).alias("v")).select("rule", "v.v")
    known = known.withColumn("full", F.sha2(F.col("rule").cast("binary"), 256)).withColumn("short", F.substring("full", 1, PREFIX))
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        known = F.broadcast(known)
    hits = wide.join(known, "short", "left")  # on the short prefix alone; the digest confirms below
    best = F.max(F.when(F.col("digest") == F.col("full"), F.struct(F.length("rule").alias("n"), F.expr("v = 'block'").alias("block"), "rule", "v")))
    out = hits.groupBy("row", "id", "host", "path").agg(best.alias("best"))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.v", F.lit(default)).alias("verdict"))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """The verdict on every URL of ``pages`` under RULES; null URLs and ties as in judge()."""
    from .common import load

    return judge(load(spark, sf_dir, "pages"), rule_table(spark))


ORACLE = """
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, row_number() over () as rn, rest, regexp_extract(rest, '^[^/?#]*') as raw from u),
p as (select page_id, rn, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from h),
r(rh, rp, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m as (select p.*, rh || rp as rule, v, row_number() over (partition by rn order by length(rh || rp) desc nulls last) as k
      from p left join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m where k = 1
"""
