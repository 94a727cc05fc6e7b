"""URL filters (operator 6): host-suffix and path-prefix expressions, joined on short hash prefixes.

A rule is a host, a path and a verdict; it fits its host and all subdomains where the url's path starts with the rule's
path, and the longest fitting rule wins (of equal length, the one with the longer host). Every url is expanded into the
suffix + prefix strings whose shape (number of host labels, length of path) some rule has; the strings meet the rules on
the first 32 bits of their SHA-256, then whole digests are compared. Few rules of few shapes go to the pages, which stay
where they are, so a common url is no hot key; else distinct urls are judged and joined back.

Cases: a null url, or one without "://", has an empty host and path, no rule, and the default verdict; very long urls are
expanded whole; of fitting rules with equal length the one with the longer host decides; repeated rows and
equal page_ids are each judged; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ._base import table

#: The rules of the query: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
DEFAULT = "allow"
#: Rules up to this many are broadcast; more are shuffled.
MOST_BROADCAST = 20_000
#: Shapes up to this many are each met in the page's own row.
MOST_SHAPES = 8
HASH_DIGITS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _expression(shape: Row) -> Column:
    """The host's last labels and the path's first characters of a shape, if there are so many."""
    labels = F.split("host", r"\.")
    both = F.concat(F.array_join(F.slice(labels, -shape.labels, shape.labels), "."), F.substring("path", 1, shape.chars))
    return F.when((F.size(labels) >= shape.labels) & (F.length("path") >= shape.chars), both)


def _in_place(pages: DataFrame, rules: DataFrame, shapes: list[Row], default: str) -> DataFrame:
    """Meets the rules of each hash prefix once for each shape; the digest then tells which of them it is."""
    rule = F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "verdict", "digest")
    listed = F.broadcast(rules.groupBy(F.col("prefix").alias("_prefix")).agg(F.collect_list(rule).alias("_rules")))
    for i, shape in enumerate(shapes):
        pages = pages.withColumn(f"_found{i}", F.sha2(_expression(shape), 256))
        pages = pages.join(listed, F.substring(f"_found{i}", 1, HASH_DIGITS) == F.col("_prefix"), "left")
        pages = pages.withColumn(f"_rule{i}", F.get(F.filter("_rules", lambda r: r["digest"] == F.col(f"_found{i}")), F.lit(0))).drop("_prefix", "_rules")
    best = F.array_max(F.array(*(f"_rule{i}" for i in range(len(shapes)))))
    return pages.select("page_id", "host", "path", best["rule"].alias("rule"), F.coalesce(best["verdict"], F.lit(default)).alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropDuplicates(["host", "path"])
    shape = F.struct(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
    known = rules.agg(F.count("*").alias("n"), F.collect_set(shape).alias("shapes")).first()
    text = F.concat("host", "path")
    rules = rules.select(F.sha2(text, 256).alias("digest"), text.alias("rule"), "verdict", F.length("host").alias("host_chars")).withColumn("prefix", F.substring("digest", 1, HASH_DIGITS))
    host, path = host_and_path(F.col("url"))
    if known.n <= MOST_BROADCAST and 0 < len(known.shapes) <= MOST_SHAPES:
        return _in_place(pages.select("page_id", host.alias("host"), path.alias("path")), rules, sorted(known.shapes), default)
    urls = pages.select("url").where("url is not null").distinct().select("url", host.alias("host"), path.alias("path"))
    strings = [_expression(shape) for shape in sorted(known.shapes)]
    if strings:
        found = urls.select("url", F.explode(F.array_compact(F.array(*strings))).alias("text"))
    else:
        found = urls.select("url", F.lit("").alias("text")).limit(0)
    found = found.select("url", F.sha2("text", 256).alias("found")).withColumn("prefix", F.substring("found", 1, HASH_DIGITS))
    found = found.join(F.broadcast(rules) if known.n <= MOST_BROADCAST else rules, "prefix").where("found = digest")
    best = found.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "verdict")).alias("best"))
    return pages.select("page_id", "url").join(best, "url", "left").select("page_id", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


QUERIES = {"op6_url_rules": op6_url_rules}
SQL = {
    "op6_url_rules": """
with a as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r from pages),
b as (select page_id, r, regexp_extract(r, '^[^/?#]*') as h from a),
c as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') as path from b),
rules(rh, rp, rv) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m as (select page_id, rh || rp as rule, rv, row_number() over (partition by page_id order by length(rh || rp) desc, length(rh) desc) as k
      from c join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select c.page_id, c.host, c.path, m.rule, coalesce(m.rv, 'allow') as verdict from c left join m on c.page_id = m.page_id and m.k = 1
""",
}
