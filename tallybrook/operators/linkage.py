"""Record linkage: ordered rules, blocked substring joins, nearest years, and links by natural keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.operators import automaton

#: Least length of a text within another, by the source's rule.
LEAST_INSIDE = 4


def grams(text: Column, n: int) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.char_length(text) - n + 1, F.lit(1)))
    return F.when(F.char_length(text) >= n, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def contains_join(long: DataFrame, short: DataFrame, text: str, part: str, least: int = 1) -> DataFrame:
    """Rows of `long` and `short` where text contains part, of `least` characters or more; an empty part is in no text.

    One automaton over the parts reads each text once; its hits meet the rows of `short` by equality.
    """
    keyed = short.where(F.char_length(part) >= max(least, 1))
    return automaton.hits(long, text, keyed, part).join(keyed, part)


def either_contains(left: DataFrame, right: DataFrame, a: str, b: str, least: int = LEAST_INSIDE) -> DataFrame:
    """Pairs where either text contains the other, the inner one of `least` characters or more (the source's rule: four)."""
    return contains_join(left, right, a, b, least).unionByName(contains_join(right, left, b, a, least)).distinct()


def longest_contained(left: DataFrame, right: DataFrame, key: str, a: str, b: str, seq: str) -> DataFrame:
    """For each left row, the longest right text that either contains it or lies in it; of equals, the first by seq."""
    pairs = either_contains(left, right, a, b)
    order = F.struct(-F.char_length(b), F.col(seq))
    names = [c for c in pairs.columns if c != key]
    return pairs.groupBy(key).agg(F.min_by(F.struct(*names), order).alias("r")).select(key, "r.*")


def year_confidence(year: Column, years: Column) -> Column:
    """0.90 in the same year, 0.80 next to it, else 0.65."""
    apart = F.array_min(F.transform(years, lambda y: F.abs(y - year)))
    return F.when(apart == 0, 0.90).when(apart == 1, 0.80).otherwise(0.65)


def nearest_year(year: Column, years: Column) -> Column:
    """The closest year; of two, the earlier."""
    best = F.array_min(F.transform(years, lambda y: F.struct(F.abs(y - year).alias("d"), y.alias("y"))))
    return best["y"]


def first_rule(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the first pattern, in order, that the text matches."""
    table = F.array(*(F.struct(F.lit(p).alias("pattern"), F.lit(label).alias("label")) for p, label in rules))
    return F.try_element_at(F.filter(table, lambda r: F.regexp_like(text, r["pattern"])), F.lit(1))["label"]


def best_rule(text: Column, rules: list[tuple[list[str], str, float]]) -> Column:
    """(label, confidence, keyword) of the rule with the highest confidence that has a keyword in the text; of equals, the first."""
    order = sorted(range(len(rules)), key=lambda i: (-rules[i][2], i))
    table = F.array(*(F.struct(F.array(*map(F.lit, rules[i][0])).alias("keywords"), F.lit(rules[i][1]).alias("label"), F.lit(rules[i][2]).alias("confidence")) for i in order))
    hit = F.try_element_at(F.filter(table, lambda r: F.exists(r["keywords"], lambda k: F.contains(text, k))), F.lit(1))
    return F.when(hit.isNotNull(), F.struct(hit["label"].alias("label"), hit["confidence"].alias("confidence"), F.try_element_at(F.filter(hit["keywords"], lambda k: F.contains(text, k)), F.lit(1)).alias("keyword")))


def dictionary_match(df: DataFrame, dictionary: DataFrame, key: str, text: str, stop: tuple[str, ...] = ()) -> DataFrame:
    """(key, equipment_id, confidence) for a dictionary of (equipment_id, keyword, confidence).

    Keywords in ASCII with a letter or digit need no letter or digit to their left; those of the stop-list count for nothing.
    The best confidence of each item counts.
    """
    word = F.col("keyword").rlike(r"^[\x00-\x7F]*[A-Za-z0-9][\x00-\x7F]*$")
    known = dictionary.where(~F.col("keyword").isin(*stop)) if stop else dictionary
    hits = automaton.hits(df, text, known.withColumn("_word", word), "keyword", "_word", [key])
    return hits.join(known, "keyword").groupBy(key, "equipment_id").agg(F.max("confidence").alias("confidence"))


def cascade(df: DataFrame, steps: list[tuple[str, Column]], default: Column) -> DataFrame:
    """Adds `assigned`: the first step's struct that is not NULL, in strict order."""
    return df.withColumn("assigned", F.coalesce(*(c for _, c in steps), default))


def bigram_jaccard_join(left: DataFrame, right: DataFrame, key: str, a: str, b: str, least: float = 0.5) -> DataFrame:
    """Pairs of texts whose sets of two characters are alike, counted from shared bigrams; equal texts are compared once."""
    x = left.select(F.col(a).alias("_a")).distinct().withColumn("_g", grams(F.col("_a"), 2)).select("_a", F.size("_g").alias("_na"), F.explode("_g").alias("_gram"))
    y = right.select(b).distinct().withColumn("_g", grams(F.col(b), 2)).select(b, F.size("_g").alias("_nb"), F.explode("_g").alias("_gram"))
    shared = x.join(y, "_gram").groupBy("_a", b).agg(F.count("*").alias("_n"), F.first("_na").alias("_na"), F.first("_nb").alias("_nb"))
    score = F.col("_n") / (F.col("_na") + F.col("_nb") - F.col("_n"))
    alike = shared.withColumn("jaccard", score).where(F.col("jaccard") >= least).select("_a", b, "jaccard")
    return left.select(key, F.col(a).alias("_a")).join(alike, "_a").select(key, b, "jaccard")


def relinked(enrichment: DataFrame, contracts: DataFrame, keys: list[str], payload: str, mode: str = "lossless") -> DataFrame:
    """Finds contract ids for rows that carry natural keys and an ordinal (dup_ordinal).

    No id: unmatched. One id and several rows: in mode 'reference' the row of the highest ordinal, else every row. Several
    ids: all of them if the payloads agree, else by position; rows past the last id are ambiguous. NULL keys are equal. No list
    of ids is built: ids are counted first, and a position is met by its number.
    """

    def joined(left: DataFrame, right: DataFrame, how: str, *more: str) -> DataFrame:
        right = right.withColumnsRenamed({c: f"_k_{c}" for c in (*keys, *more)})
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*keys, *more)])
        return left.join(right, on, how).drop(*(f"_k_{c}" for c in (*keys, *more)))

    ids = contracts.groupBy(*keys).agg(F.count("*").alias("_n"))
    group = enrichment.groupBy(*keys).agg(F.count_distinct(payload).alias("_payloads"), F.max("dup_ordinal").alias("_last"))
    e = joined(joined(enrichment, group, "inner"), ids, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    every = (F.col("_n") > 0) & ((F.col("_n") == 1) | (F.col("_payloads") <= 1))
    kept_out = (F.col("_n") == 1) & F.lit(mode == "reference") & (F.col("dup_ordinal") < F.col("_last"))
    placed = ~every & F.col("dup_ordinal").between(1, F.col("_n"))
    status = F.when(F.col("_n") == 0, "unmatched").when(every | placed, "matched").otherwise("ambiguous")
    e = e.withColumns({"status": status, "_way": F.when(every & ~kept_out, "all").when(placed, "place").otherwise("none")}).drop("_n", "_payloads", "_last")
    told = [*enrichment.columns, "status", "id"]
    numbered = contracts.select(*keys, "id", F.row_number().over(Window.partitionBy(*keys).orderBy("id")).alias("dup_ordinal"))
    out = joined(e.where("_way = 'all'"), contracts.select(*keys, "id"), "inner").select(told)
    out = out.unionByName(joined(e.where("_way = 'place'"), numbered, "inner", "dup_ordinal").select(told))
    return out.unionByName(e.where("_way = 'none'").withColumn("id", F.lit(None).cast(contracts.schema["id"].dataType)).select(told))


def with_ordinals(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.withColumn("dup_ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def multi_strategy(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], value: str) -> DataFrame:
    """Left joins on each pair of key columns; `value` and `strategy` of the first that hits."""
    out = left
    for i, (a, b) in enumerate(keys):
        one = right.where(F.col(b).isNotNull()).groupBy(F.col(b).alias(f"_k{i}")).agg(F.min(value).alias(f"_v{i}"))
        out = out.join(one, F.col(a) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    n = range(len(keys))
    hit = reduce(lambda c, i: c.when(F.col(f"_v{i}").isNotNull(), F.lit(keys[i][0])), n, F.when(F.lit(False), F.lit("")))
    return out.withColumns({value: F.coalesce(*(F.col(f"_v{i}") for i in n)), "strategy": hit}).drop(*(f"_v{i}" for i in n))


def latest_like(wanted: DataFrame, known: DataFrame, key: str, word: str, name: str, year: str, seq: str) -> DataFrame:
    """(key, name, year, seq) of the known row of the latest year whose name holds the word; of equals the first by name, then by seq.

    Words and names are compared once each: the latest row of each name first, then the best name of each word.
    """
    newest = known.where(F.col(name).isNotNull()).groupBy(name).agg(F.min_by(F.struct(year, seq), F.struct(-F.col(year), F.col(seq))).alias("_r")).select(name, F.col("_r")[year].alias(year), F.col("_r")[seq].alias(seq))
    words = wanted.select(F.col(word).alias("_word")).distinct()
    hits = contains_join(newest, words, name, "_word")
    best = hits.groupBy("_word").agg(F.min_by(F.struct(name, year, seq), F.struct(-F.col(year), F.col(name))).alias("_r"))
    return wanted.select(key, F.col(word).alias("_word")).join(best, "_word").select(key, "_r.*")


def by_name_forms(wanted: DataFrame, known: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """(key, value, form) by the whole name, else by the name with its ends trimmed and wide spaces made plain; of equal names the least value."""
    plain = lambda c: F.trim(F.replace(c, F.lit("\u3000"), F.lit(" ")))
    forms = lambda df: df.withColumns({"exact": F.col(name), "plain": plain(F.col(name))})
    other = forms(known.select(name, value)).select(F.col("exact").alias("_exact"), F.col("plain").alias("_plain"), value)
    out = multi_strategy(forms(wanted.select(key, name)), other, [("exact", "_exact"), ("plain", "_plain")], value)
    return out.where(F.col(value).isNotNull()).select(key, value, F.col("strategy").alias("form"))
