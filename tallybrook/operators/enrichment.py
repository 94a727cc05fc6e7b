"""Classification of contracts: the requesting organisation, and the category, by strict cascades over input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import dates, text
from tallybrook.operators import linkage, votes


def _answer(org: Column, source: str, confidence: Column | float, ref: Column | None = None) -> Column:
    c = confidence if isinstance(confidence, Column) else F.lit(confidence)
    return F.when(org.isNotNull(), F.struct(org.alias("org"), F.lit(source).alias("source"), c.cast("double").alias("confidence"), (ref if ref is not None else F.lit(None)).cast("bigint").alias("ref")))


def requesting_org(
    contracts: DataFrame, planned: DataFrame, agency_rules: list[tuple[str, str]], overrides: list[tuple[str, str]], inferred: list[tuple[str, str]], vendor_rules: list[tuple[str, str]], default: str,
    explicit: list[tuple[str, str]] | None = None, branches: DataFrame | None = None, joint: DataFrame | None = None,
) -> DataFrame:
    """id and the first answer of: agency (of other agencies than the central one, else the default), sub-agency, exact name,
    contained name, override, month or majority among planned items of the name, equipment's branch, vendor, explicit keywords,
    inferred keywords, joint equipment, default.

    contracts: id, agency_id, contract_name, name_norm, vendor_name, contract_date, fiscal_year. planned: id, org,
    name_norm, fiscal_year, month (fiscal numbering), each id first seen in its order. branches: id, branch, seq of the
    equipment linked to a contract, whose majority counts; joint: id, org of joint equipment, which counts if unanimous.
    """
    one = planned.groupBy("name_norm").agg(F.min("org").alias("_lo"), F.max("org").alias("_hi"), F.min("id").alias("ref"), F.collect_set("fiscal_year").alias("years"))
    single = one.where("_lo = _hi").select("name_norm", F.col("_lo").alias("one_org"), "ref", "years")
    exact = single.select("name_norm", F.col("one_org").alias("exact_org"), F.col("ref").alias("exact_ref"))
    names = contracts.select("name_norm", F.col("name_norm").alias("_name")).where("name_norm is not null").distinct()
    near = linkage.longest_contained(names, single.select(F.col("name_norm").alias("part"), "one_org", "ref", "years"), "name_norm", "_name", "part", "ref").select("name_norm", F.col("one_org").alias("near_org"), F.col("ref").alias("near_ref"), "years")
    several = planned.join(one.where("_lo <> _hi").select("name_norm"), "name_norm")
    most = votes.majority(several, "name_norm", "org", "id")
    most = most.join(several.groupBy("name_norm", "org").agg(F.min("id").alias("most_ref")), ["name_norm", "org"]).select("name_norm", F.col("org").alias("most_org"), "most_ref")
    by_month = several.groupBy("name_norm", "month").agg(F.min("org").alias("_lo"), F.max("org").alias("_hi"), F.min("id").alias("_ref"))
    by_month = by_month.where("month is not null").select("name_norm", "month", F.struct(F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("org"), F.col("_ref").alias("ref")).alias("at"))
    fiscal = by_month.select("name_norm", F.col("month").alias("_fiscal"), F.col("at").alias("fiscal_at"))
    plain = by_month.select("name_norm", F.col("month").alias("_plain"), F.col("at").alias("plain_at"))
    month = dates.month_of_text(F.col("contract_date"))
    c = contracts.withColumns({"_fiscal": dates.fiscal_month(month), "_plain": month, "_text": text.nfkc(F.col("contract_name")), "_vendor": F.trim(text.nfkc(F.col("vendor_name")))})
    c = c.join(exact, "name_norm", "left").join(near, "name_norm", "left").join(most, "name_norm", "left").join(fiscal, ["name_norm", "_fiscal"], "left").join(plain, ["name_norm", "_plain"], "left")
    none = lambda name: F.lit(None).cast("string").alias(name)
    if branches is not None:
        c = c.join(votes.majority(branches, "id", "branch", "seq").select("id", F.col("branch").alias("_branch")), "id", "left")
    else:
        c = c.select("*", none("_branch"))
    c = c.join(votes.unanimous(joint, "id", "org").select("id", F.col("org").alias("_joint")), "id", "left") if joint is not None else c.select("*", none("_joint"))
    agency = F.coalesce(*(F.when(F.col("agency_id") == a, F.lit(o)) for a, o in agency_rules), F.lit(None).cast("string"))
    central = F.lower("agency_id").like(r"atla\_%") | (F.lower("agency_id") == "atla")
    sub = F.when(F.lower("agency_id").like(r"atla\_%"), F.lit(default))
    vendor = F.coalesce(*(F.when(F.startswith("_vendor", F.lit(v)), F.lit(o)) for v, o in vendor_rules), F.lit(None).cast("string"))
    in_month = F.coalesce("fiscal_at", "plain_at")  # the calendar's month counts only where no item is of the fiscal one
    fallback = _answer(F.lit(default), "fallback", 0.3)
    steps = [
        ("agency", _answer(agency, "agency", 1.0)),
        ("other_agency", F.when(~F.coalesce(central, F.lit(False)), fallback)),
        ("sub_agency", _answer(sub, "sub_agency", 0.5)),
        ("exact", _answer(F.col("exact_org"), "exact", 0.9, F.col("exact_ref"))),
        ("contained", _answer(F.col("near_org"), "contained", linkage.year_confidence(F.col("fiscal_year"), F.col("years")), F.col("near_ref"))),
        ("override", _answer(linkage.first_rule(F.col("contract_name"), overrides), "override", 0.85)),
        ("month", _answer(in_month["org"], "month", 0.7, in_month["ref"])),
        ("majority", _answer(F.col("most_org"), "majority", 0.5, F.col("most_ref"))),
        ("branch", _answer(F.col("_branch"), "branch", 0.7)),
        ("vendor", _answer(vendor, "vendor", 0.5)),
        ("keyword", _answer(linkage.first_rule(F.col("_text"), explicit or []), "keyword", 0.75) if explicit else F.lit(None)),
        ("inferred", _answer(linkage.first_rule(F.col("_text"), inferred), "inferred", 0.5) if inferred else F.lit(None)),
        ("joint", _answer(F.col("_joint"), "inferred", 0.5)),
    ]
    return linkage.cascade(c, steps, fallback).select("id", "assigned.*")


def category(contracts: DataFrame, rules: list[tuple[list[str], str, float]], follow_up: list[tuple[str, str, float, float]]) -> DataFrame:
    """id, label, confidence, keyword: the most confident rule, then rules that replace what is under a bar, in order.

    follow_up: (pattern, label, confidence, bar): where the pattern fits and the confidence so far is under the bar.
    """
    hit = linkage.best_rule(F.col("contract_name"), rules)
    out = contracts.select("id", "contract_name", hit["label"].alias("label"), hit["confidence"].cast("double").alias("confidence"), hit["keyword"].alias("keyword"))
    for pattern, label, confidence, bar in follow_up:
        apply = F.coalesce(F.col("contract_name").rlike(pattern), F.lit(False)) & (F.coalesce("confidence", F.lit(0.0)) < bar)
        out = out.select("id", "contract_name", F.when(apply, F.lit(label)).otherwise(F.col("label")).alias("label"), F.when(apply, F.lit(confidence)).otherwise(F.col("confidence")).alias("confidence"), F.when(apply, F.lit(pattern)).otherwise(F.col("keyword")).alias("keyword"))
    return out.drop("contract_name")


def org_fallback(classified: DataFrame, rules: list[tuple[Column, str, float]]) -> DataFrame:
    """Rules in turn over rows that have no label yet; each sees what the ones before it did."""
    out = classified
    for condition, label, confidence in rules:
        apply = F.col("label").isNull() & F.coalesce(condition, F.lit(False))
        out = out.withColumns({"confidence": F.when(apply, F.lit(confidence)).otherwise(F.col("confidence")), "label": F.when(apply, F.lit(label)).otherwise(F.col("label"))})
    return out


def programme_fallback(contracts: DataFrame, programmes: DataFrame, least: int = 6) -> DataFrame:
    """id, org: of programmes whose name and the contract's contain one another, if all agree; else the plurality of shared terms.

    contracts: id, name_norm; programmes: name_norm, org, terms. Names are compared once each, however many rows have them.
    """
    names = contracts.select(F.col("name_norm").alias("a")).where("a is not null").distinct()
    long = programmes.where(F.char_length("name_norm") >= least).select(F.col("name_norm").alias("b"), "org").distinct()
    whole = linkage.either_contains(names, long, "a", "b").where((F.char_length("a") >= least) & (F.char_length("b") >= least))
    agreed = whole.groupBy("a").agg(F.min("org").alias("_least"), F.max("org").alias("_most"))  # one row a name
    rows = contracts.select("id", F.col("name_norm").alias("a"))
    full = rows.join(agreed, "a").groupBy("id").agg(F.min("_least").alias("_least"), F.max("_most").alias("_most")).where("_least = _most").select("id", F.col("_least").alias("full_org"))
    words = programmes.select("org", F.explode("terms").alias("term")).distinct()
    hits = linkage.contains_join(names, words, "a", "term").where("org is not null").groupBy("a", "org").agg(F.count("*").alias("n"))
    some = votes.plurality(rows.join(hits, "a").select("id", "org", "n"), "id", "org", "n").select("id", F.col("org").alias("some_org"))
    out = contracts.select("id").join(full, "id", "left").join(some, "id", "left")
    return out.select("id", F.coalesce("full_org", "some_org").alias("org"), F.when(F.col("full_org").isNotNull(), "full_match").when(F.col("some_org").isNotNull(), "kw_match").alias("source")).where("org is not null")


def agreement(predicted: DataFrame, labelled: DataFrame, key: str) -> DataFrame:
    """Rows of both and the share on which they agree."""
    both = predicted.select(key, F.col("label").alias("_a")).join(labelled.select(key, F.col("label").alias("_b")), key)
    return both.agg(F.count("*").alias("rows"), F.round(F.avg((F.col("_a") == F.col("_b")).cast("int")), 6).alias("accuracy"))


def majority_cascade(rows: DataFrame, voters: DataFrame, only: str, majority: str, default: str) -> DataFrame:
    """id, source, org, confidence: the row's org where its vendor has a single row, else the majority of the vendor's
    voters (of equals, the first by seq), else the default.

    rows: id, vendor, org; voters: vendor, org, seq.
    """
    alone = rows.groupBy("vendor").agg(F.count("*").alias("_n"))
    most = votes.majority(voters, "vendor", "org", "seq").select("vendor", F.col("org").alias("_most"))
    joined = rows.join(alone, "vendor").join(most, "vendor", "left")
    steps = [(only, _answer(F.when(F.col("_n") == 1, F.col("org")), only, 0.9)), (majority, _answer(F.col("_most"), majority, 0.5))]
    return linkage.cascade(joined, steps, _answer(F.lit(default), "default", 0.3)).select("id", "assigned.source", "assigned.org", "assigned.confidence")


def catalogue(rules: DataFrame, pattern: str, label: str, between: str = "|") -> DataFrame:
    """A table of rules (rule, a pattern of alternatives, label, confidence) for browsing: a row for each keyword, with its place in
    its rule and how many rules share it."""
    each = rules.select("rule", F.posexplode(F.split(pattern, "\\Q" + between + "\\E")).alias("_at", "keyword"), F.col(label).alias("label"), "confidence")
    each = each.select("rule", (F.col("_at") + 1).alias("place"), F.trim("keyword").alias("keyword"), "label", "confidence").where("keyword <> ''")
    return each.join(each.groupBy("keyword").agg(F.count_distinct("rule").alias("rules")), "keyword").select("rule", "place", "keyword", "label", "confidence", "rules")
