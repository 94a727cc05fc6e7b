"""Queries that read whole tables, against counts made in pandas."""

import pandas as pd

from tallybrook.plans import registry


def events(sf):
    e = pd.read_parquet(f"{sf}/events.parquet")
    return e, e.ts < "2024-01-16"


def test_null_safe_join_reads_every_event(spark, sf):
    e, early = events(sf)
    key = pd.Series(list(zip(e.user_id % 10, e.event_type)))  # 0 stands for NULL, equal to itself
    later = key[~early].value_counts()
    want = {i: later[k] for i, k in zip(e.event_id[early], key[early]) if k in later}
    got = {r.event_id: r.n for r in registry.QUERIES["null_safe_join_all"](spark, sf).collect()}
    assert got == want and early.sum() + (~early).sum() == len(e) and len(got) > 400


def test_upsert_reads_every_event(spark, sf):
    e, early = events(sf)
    e = e.sort_values("event_id")
    want = e[early].groupby("user_id").event_id.first().to_dict() | e[~early].groupby("user_id").event_id.last().to_dict()
    got = registry.QUERIES["upsert_last_all"](spark, sf).collect()
    assert {r.user_id: r.event_id for r in got} == want and len(got) == e.user_id.nunique()


def test_display_shows_every_contract(spark, sf):
    got = [r.id for r in registry.QUERIES["display_columns_all"](spark, sf).collect()]
    assert sorted(got) == sorted(pd.read_parquet(f"{sf}/orders.parquet").o_orderkey) and len(got) > 500


def test_set_union_keeps_every_day(spark, sf):
    e, _ = events(sf)
    want = (e.ts.dt.month * 100 + e.ts.dt.day).groupby(e.event_type).agg(lambda d: sorted(set(d))).to_dict()
    assert {r.event_type: r.days for r in registry.QUERIES["set_union_per_key_all"](spark, sf).collect()} == want


def test_years_are_those_of_the_contracts(spark, sf):
    years = (pd.to_datetime(pd.read_parquet(f"{sf}/orders.parquet").o_orderdate) - pd.DateOffset(months=3)).dt.year
    method = registry.QUERIES["method_pivot_all"](spark, sf).toPandas()
    assert method.groupby("fiscal_year").n.sum().to_dict() == years.value_counts().to_dict() and len(method) == method.bid_method.nunique() * years.nunique()
    ranks = registry.QUERIES["rank_matrix_all"](spark, sf).toPandas()
    assert set(ranks.fiscal_year) == set(years) and len(ranks) == 20 * years.nunique()
