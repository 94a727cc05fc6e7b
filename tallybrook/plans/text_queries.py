"""Queries over texts, urls, pages, vectors and dictionaries: search, rules, linkage and parsing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import text
from tallybrook.operators import automaton, fuzzy, linkage, passages
from tallybrook.plans.ledger_queries import BEST_SQL
from tallybrook.sources import grids
from tallybrook.sources.ledger import CONTRACTS_SQL, contracts, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{contracts}", CONTRACTS_SQL)
        return f

    return add


@query("select p_partkey, p_name from part where p_name ilike '%SMALL%' order by p_retailprice is null, p_retailprice desc, p_partkey limit 50")
def keyword_search(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "part").where(text.nfkc(F.col("p_name")).ilike("%SMALL%"))
    return found.orderBy(F.desc_nulls_last("p_retailprice"), "p_partkey").limit(50).select("p_partkey", "p_name")


@query("select doc_id from documents where contains(lower(text), 'the') and contains(lower(text), 'mail')")
def and_tokens(spark: SparkSession, sf: str) -> DataFrame:
    where = reduce(lambda a, b: a & b, [F.contains(F.lower("text"), F.lit(t)) for t in ("the", "mail")])
    return table(spark, sf, "documents").where(where).select("doc_id")


@query("select p_partkey, regexp_matches(p_type, '[A-Z]{5}') as shouted, p_brand like 'Brand#1%' as prefix from part where regexp_matches(p_name, '(?i)RING') or regexp_matches(p_brand, '(?i)brand#2')")
def glob_class(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").where(F.col("p_name").rlike("(?i)RING") | F.col("p_brand").rlike("(?i)brand#2"))
    return p.select("p_partkey", F.col("p_type").rlike("[A-Z]{5}").alias("shouted"), F.startswith("p_brand", F.lit("Brand#1")).alias("prefix"))


def _l2(df: DataFrame, choice: str | None) -> DataFrame:
    """None: no filter; 'unclassified': NULL or equal to the first level; else exact."""
    if choice is None:
        return df
    return df.where(F.col("l2").isNull() | (F.col("l2") == F.col("l1"))) if choice == "unclassified" else df.where(F.col("l2") == choice)


@query("select p_partkey from (select p_partkey, p_size % 8 as l1, nullif(p_size, 10) as l2 from part) where l2 is null or l2 = l1")
def tri_state_l2(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 8).alias("l1"), F.nullif("p_size", F.lit(10)).alias("l2"))
    return _l2(p, "unclassified").select("p_partkey")


@query("select p_partkey, case when p_size <= 8 then p_size else p_size // 10 end as l1, case when p_size <= 8 then null else p_size end as l2 from part")
def code_split(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", F.when(s <= 8, s).otherwise(F.floor(s / 10).cast("int")).alias("l1"), F.when(s > 8, s).alias("l2"))


RULES = [("small", "S"), ("large", "L"), ("ring|bolt", "fastener")]


@query("select p_partkey, case when regexp_matches(p_name, 'small') then 'S' when regexp_matches(p_name, 'large') then 'L' when regexp_matches(p_name, 'ring|bolt') then 'fastener' end as label from part")
def ordered_rules(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", linkage.first_rule(F.col("p_name"), RULES).alias("label"))


WEIGHTED = [(["ring", "bolt"], "fastener", 0.6), (["red", "blue"], "colour", 0.8), (["small"], "size", 0.8)]


@query("select p_partkey, case when contains(p_name, 'red') or contains(p_name, 'blue') then 'colour' when contains(p_name, 'small') then 'size' when contains(p_name, 'ring') or contains(p_name, 'bolt') then 'fastener' end as label, case when contains(p_name, 'red') or contains(p_name, 'blue') or contains(p_name, 'small') then 0.8 when contains(p_name, 'ring') or contains(p_name, 'bolt') then 0.6 end::double as confidence from part")
def best_rule(spark: SparkSession, sf: str) -> DataFrame:
    r = linkage.best_rule(F.col("p_name"), WEIGHTED)
    return table(spark, sf, "part").select("p_partkey", r.alias("r")).select("p_partkey", "r.label", F.col("r.confidence").cast("double").alias("confidence"))


@query("with {contracts}, " + BEST_SQL + """, r as (select c.id, case when agency = 'NATION_7' then 'agency' when b.confidence >= 0.98 then 'equipment' when priority = '1-URGENT' then 'priority' else 'fallback' end as source from contracts c left join best b on b.id = c.id)
select id, source, case source when 'agency' then 1.0 when 'equipment' then 0.7 when 'priority' then 0.5 else 0.3 end::double as confidence from r""")
def priority_cascade(spark: SparkSession, sf: str) -> DataFrame:
    from tallybrook.plans.ledger_queries import _best

    label = lambda name, c: F.struct(F.lit(name).alias("source"), F.lit(c).alias("confidence"))
    steps = [("agency", F.when(F.col("agency") == "NATION_7", label("agency", 1.0))), ("equipment", F.when(F.col("best") >= 0.98, label("equipment", 0.7))), ("priority", F.when(F.col("priority") == "1-URGENT", label("priority", 0.5)))]
    c = contracts(spark, sf).join(_best(spark, sf).select("id", F.col("confidence").alias("best")), "id", "left")
    return linkage.cascade(c, steps, label("fallback", 0.3)).select("id", "assigned.*")


def _names(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Short texts on both sides: page addresses, and the words of part names."""
    pages = table(spark, sf, "pages").select("page_id", F.lower("url").alias("a"))
    hosts = table(spark, sf, "pages").select(F.regexp_extract("url", "://([^./]+)", 1).alias("b")).where("length(b) >= 4").groupBy("b").agg(F.lit(0).alias("seq"))
    return pages, hosts


@query("with p as (select page_id, lower(url) as a from pages), h as (select distinct regexp_extract(url, '://([^./]+)', 1) as b from pages where length(regexp_extract(url, '://([^./]+)', 1)) >= 4) select distinct page_id, b from p join h on contains(a, b) or contains(b, a)")
def blocked_bidirectional(spark: SparkSession, sf: str) -> DataFrame:
    pages, hosts = _names(spark, sf)
    return linkage.either_contains(pages, hosts, "a", "b").select("page_id", "b").distinct()


@query("with p as (select page_id, lower(url) as a from pages), h as (select distinct regexp_extract(url, '://([^./]+)', 1) as b from pages where length(regexp_extract(url, '://([^./]+)', 1)) >= 4) select page_id, b from (select page_id, b, row_number() over (partition by page_id order by length(b) desc, b) as k from p join h on contains(a, b) or contains(b, a)) where k = 1")
def longest_substring(spark: SparkSession, sf: str) -> DataFrame:
    pages, hosts = _names(spark, sf)
    return linkage.longest_contained(pages, hosts.drop("seq").withColumn("seq", F.col("b")), "page_id", "a", "b", "seq").select("page_id", "b")


@query("""with d as (select p_partkey as id, p_name as t from part), k(equipment_id, keyword, confidence) as (values (1, 'ring', 1.0), (1, 'small ring', 0.8), (2, 'red', 0.8), (3, 'idget', 0.6))
select id, equipment_id, max(confidence)::double as confidence from d join k on regexp_matches(t, case when regexp_matches(keyword, '^[A-Za-z0-9]+$') then '(^|[^A-Za-z0-9])' || keyword else keyword end) group by 1, 2""")
def dictionary_match(spark: SparkSession, sf: str) -> DataFrame:
    words = spark.createDataFrame([(1, "ring", 1.0), (1, "small ring", 0.8), (2, "red", 0.8), (3, "idget", 0.6)], "equipment_id int, keyword string, confidence double")
    return linkage.dictionary_match(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("t")), words, "id", "t")


@query("""with x as (select p_partkey, p_name, unnest(list_distinct(list_transform(range(1, length(p_name)), lambda i: p_name[i:i+1]))) as g from part), y as (select n, unnest(list_distinct(list_transform(range(1, length(n)), lambda i: n[i:i+1]))) as g from (values ('small rings'), ('red widgets'), ('blue gear')) v(n)),
nx as (select p_partkey, count(*) as k from x group by 1), ny as (select n, count(*) as k from y group by 1), s as (select p_partkey, n, count(*) as k from x join y on x.g = y.g group by 1, 2)
select s.p_partkey, s.n as name, round(cast(s.k as double) / (nx.k + ny.k - s.k), 6) as jaccard from s join nx on nx.p_partkey = s.p_partkey join ny on ny.n = s.n where cast(s.k as double) / (nx.k + ny.k - s.k) >= 0.5""")
def bigram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.createDataFrame([("small rings",), ("red widgets",), ("blue gear",)], "name string")
    return linkage.bigram_jaccard_join(table(spark, sf, "part"), names, "p_partkey", "p_name", "name").withColumn("jaccard", F.round("jaccard", 6))


@query("""with t as (select distinct p_name || ' ' || lower(p_brand) as a from part), n as (select regexp_replace(p_name, '$', 's') || ' ' || lower(p_brand) as b, min(p_partkey) as seq from part where p_size <= 2 group by 1),
w as (select a, b, seq, list_sort(list_distinct(string_split(a, ' '))) as x, list_sort(list_distinct(string_split(b, ' '))) as y from t, n),
d as (select *, array_to_string(list_sort(list_intersect(x, y)), ' ') as base, array_to_string(list_filter(x, lambda v: not list_contains(y, v)), ' ') as l, array_to_string(list_filter(y, lambda v: not list_contains(x, v)), ' ') as r from w),
c as (select *, list_reduce(string_split(l, ''), lambda row, ch: list_reduce(range(1, length(r) + 1), lambda new, j: list_append(new, case when r[j] = ch then row[j] + 1 else greatest(row[j + 1], new[j]) end), [0::bigint]), list_transform(range(0, length(r) + 1), lambda i: 0::bigint)) as rows from d),
e as (select a, b, seq, length(base) as s, length(l) as p, length(r) as q, coalesce(rows[length(r) + 1], 0) as m from c),
f as (select a, b, seq, case when s > 0 and (p = 0 or q = 0) then 100.0::double when s = 0 then 200.0::double * m / (p + q)
  else greatest(200.0::double * (s + 1 + m) / (2 * s + 2 + p + q), 200.0::double * s / (2 * s + 1 + p), 200.0::double * s / (2 * s + 1 + q)) end as score from e),
g as (select *, row_number() over (partition by a order by score desc, seq) as k from f where score >= 78)
select p_partkey, b as name, round(score / 100, 3) as confidence from part join g on g.a = p_name || ' ' || lower(p_brand) where k = 1""")
def fuzzy_best(spark: SparkSession, sf: str) -> DataFrame:
    """Each part's name and brand against a list of those of a few sizes, in the plural."""
    part = table(spark, sf, "part").select("p_partkey", "p_size", F.concat_ws(" ", "p_name", F.lower("p_brand")).alias("text"), F.concat("p_name", F.lit("s "), F.lower("p_brand")).alias("name"))
    return fuzzy.best(part, part.where("p_size <= 2"), "p_partkey", "text", "name", "p_partkey")


@query("""with m as (select label, i, avg(embedding[i]) as m from embeddings, range(1, 65) t(i) group by 1, 2), c as (select label, list(m order by i) as v from m group by 1),
s as (select vec_id, c.label, list_sum(list_transform(list_zip(embedding, v), lambda p: p[1] * p[2])) as d from embeddings, c),
r as (select *, row_number() over (partition by vec_id order by d desc, label desc) as k from s) select vec_id, label, round(d, 4) as confidence from r where k = 1 and round(d, 4) >= 0""")
def embedding_argmax(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    means = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    means = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m")))["m"].alias("embedding"))
    return passages.nearest(e, means, "vec_id", "embedding", "label", 0.0)


@query("select d.doc_id, l.quality, count(*) as n from documents d join labels l on l.doc_id = d.doc_id group by 1, 2")
def agreement(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id").groupBy("doc_id", "quality").agg(F.count("*").alias("n"))


@query("select page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) as host, case when regexp_matches(lower(regexp_extract(url, '^[^?#]*')), '[.]html$') then 'page' else 'other' end as kind, substr(sha256(url), 1, 16) as key from pages")
def url_functions(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    kind = F.when(F.lower(F.regexp_extract(u, "^[^?#]*", 0)).rlike(r"[.]html$"), "page").otherwise("other")
    return table(spark, sf, "pages").select("page_id", text.host(u).alias("host"), kind.alias("kind"), text.cache_key(u).alias("key"))


@query("select page_id, count(*) as rows from (select page_id, unnest(regexp_extract_all(html, '(?is)<p[^>]*>')) as p from pages) group by 1")
def html_elements(spark: SparkSession, sf: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit("(?is)<p[^>]*>"), F.lit(0))
    return table(spark, sf, "pages").select("page_id", F.explode(found).alias("p")).groupBy("page_id").agg(F.count("*").alias("rows"))


@query("""with l as (select page_id, url, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href\\s*=\\s*["'']?([^"''\\s>]+)', 1)) as link from pages)
select distinct page_id, case when regexp_matches(link, '^[a-z]+://') then link when starts_with(link, '/') then regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || link else regexp_extract(url, '^([a-z]+://[^?#]*/)', 1) || link end as link from l""")
def html_links(spark: SparkSession, sf: str) -> DataFrame:
    return grids.html_links(table(spark, sf, "pages"), [""])


@query("select event_id, cast(json_extract(props, '$.k') as integer) as k from events")
def json_payload(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("""with p as (select page_id, url as exact, regexp_extract(url, '^[^?#]*') as page from pages), a as (select exact as k, min(page_id) as v from p where starts_with(exact, 'https:') group by 1), b as (select page as k, min(page_id) as v from p group by 1)
select page_id, coalesce(a.v, b.v) as doc, case when a.v is not null then 'exact' when b.v is not null then 'page' end as strategy from p left join a on a.k = p.exact left join b on b.k = p.page""")
def multi_strategy(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of the same address, if it is a secure one, else of the same address without its query."""
    p = table(spark, sf, "pages").select("page_id", F.col("url").alias("exact"), F.regexp_extract("url", "^[^?#]*", 0).alias("page"))
    known = p.select(F.when(F.startswith("exact", F.lit("https:")), F.col("exact")).alias("address"), F.col("page").alias("bare"), F.col("page_id").alias("doc"))
    return linkage.multi_strategy(p, known, [("exact", "address"), ("page", "bare")], "doc").select("page_id", "doc", "strategy")


@query("select b.item_id, count(*) as documents from benchmark b join documents d on contains(d.text, b.text) where b.text <> '' group by 1")
def benchmark_containment(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that hold a benchmark passage: all passages are sought in one reading of a text; an empty one is in none."""
    wanted = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("part"))
    held = automaton.hits(table(spark, sf, "documents").select("doc_id", "text"), "text", wanted, "part", keep=["doc_id"])
    return held.join(wanted, "part").groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"))


@query("""with k as (select item_id, unnest(regexp_extract_all(text, '[A-Za-z]{7,}')) as keyword from benchmark), w as (select distinct keyword from k),
h as (select doc_id, keyword from documents join w on contains(text, keyword) where regexp_matches(text, '(^|[^A-Za-z0-9])' || keyword))
select doc_id, item_id as equipment_id, max(length(keyword) / 100.0)::double as confidence from h join k using (keyword) group by 1, 2""")
def benchmark_words(spark: SparkSession, sf: str) -> DataFrame:
    """The words of seven letters or more of all benchmark texts as a dictionary, sought in all documents."""
    words = table(spark, sf, "benchmark").select(F.col("item_id").alias("equipment_id"), F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{7,}"), F.lit(0))).alias("keyword"))
    known = words.distinct().withColumn("confidence", (F.char_length("keyword") / F.lit(100.0)))
    return linkage.dictionary_match(table(spark, sf, "documents").select("doc_id", "text"), known, "doc_id", "text")
