"""URL rules by hashed host-suffix and path-prefix expressions: short-prefix equi-join, then full digests and rule precedence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_broadcast

#: Hex digits of the digest prefix that is joined on (32 bits).
PREFIX = 8
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, 'host/path') pairs as a table verdict, rule."""
    return spark.createDataFrame(rules, "verdict string, rule string")


def split_rules(rules: DataFrame) -> DataFrame:
    """verdict, rule, host, path, labels, depth, prefix, digest. An expression is the host, a slash and the rule's path up to
    its last slash; what follows the last slash is compared after the join. Of equal rules a block wins."""
    parts = rules.select(
        "verdict", "rule", F.translate(F.substring_index("rule", "/", 1), *LOWER).alias("host"), F.expr("substring(rule, instr(rule, '/'))").alias("path")
    ).where("instr(rule, '/') > 0")
    best = parts.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct("verdict", "rule")).alias("r")).select("r.rule", "r.verdict", "host", "path")
    folder = F.regexp_extract("path", r"(?s)^.*/", 0)
    digest = F.sha2(F.concat("host", folder), 256)
    return best.select("rule", "verdict", "host", "path", F.size(F.split("host", r"\.")).alias("labels"), F.size(F.split(folder, "/")).alias("depth"), F.substring(digest, 1, PREFIX).alias("prefix"), digest.alias("digest"))


def host_and_path(url) -> tuple:
    """Columns host (A-Z lower-cased) and path of a url column; both empty for a null or a url without '://'."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), *LOWER), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge_urls(urls: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """key, host, path, rule, verdict of every row of urls (key, url, ...). rules: verdict, rule ('host/path').

    A rule fits its host and all subdomains where the url's path starts with the rule's path; the longest fitting rule wins
    (then the longer host, then block). Urls that no rule fits get rule null and the default verdict, as do null urls and those
    without '://' (host and path empty). Each url expands to its host suffixes times its path prefixes at slashes, but only to
    as many labels and slashes as any rule has, so a very long url expands no further than the rules reach. The equi-join on
    4-byte prefixes, the full digests and the winner are found per distinct (host, path), which hot hosts fold into. Repeated
    keys are judged row by row; rows with clashing column names keep only key and url.
    """
    parsed = urls.select(F.col(key), F.col("url").cast("string").alias("_url")).select(key, *(c.alias(n) for c, n in zip(host_and_path("_url"), ("host", "path"), strict=True)))
    known = split_rules(rules)
    reach = known.agg(F.max("labels").alias("labels"), F.max("depth").alias("depth")).first()
    labels, depth = reach["labels"] or 0, reach["depth"] or 0
    sites = parsed.where("host <> ''").select("host", "path").distinct()
    # suffixes of 1..labels labels; path prefixes with 1..depth - 1 slashes
    suffixes = F.expr(f"transform(sequence(1, least({max(labels, 1)}, size(split(host, '\\\\.')))), k -> substring_index(host, '.', -k))")
    prefixes = F.expr(f"transform(filter(sequence(1, {max(depth - 1, 1)}), k -> k < size(split(path, '/'))), k -> concat(substring_index(path, '/', k), '/'))")
    if not labels:
        return parsed.select(key, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    expanded = sites.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("folders")).select("host", "path", F.explode("folders").alias("folder"), "suffix")
    expanded = expanded.withColumn("full", F.sha2(F.concat("suffix", "folder"), 256)).withColumn("prefix", F.substring("full", 1, PREFIX))
    table = known.select("rule", "verdict", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "prefix", "digest")
    hits = expanded.join(small_broadcast(table), "prefix").where("full = digest and suffix = rule_host and startswith(path, rule_path)")
    order = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), F.col("verdict").alias("v"), F.col("rule").alias("r"))
    won = hits.groupBy("host", "path").agg(F.max(order).alias("w")).select("host", "path", F.col("w.r").alias("rule"), F.col("w.v").alias("verdict"))
    return parsed.join(won, ["host", "path"], "left").select(key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: The rules that op2_url_filter applies.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

ORACLE = """
with parts as (select page_id, case when contains(coalesce(url, ''), '://') then substring(url, instr(url, '://') + 3) else '' end as rest from pages),
sites as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
rules(verdict, host, path) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits as (select s.page_id, r.host || r.path as rule, r.verdict, row_number() over (partition by s.page_id order by length(r.host || r.path) desc, length(r.host) desc, r.verdict desc) as place
  from sites s join rules r on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path))
select s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') as verdict from sites s left join fits f on s.page_id = f.page_id and f.place = 1
"""
