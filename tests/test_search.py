"""Search specifications and the entry module."""

import pytest

import __spark_entry__
from tallybrook.plans import registry, search


@pytest.fixture
def ledger(spark):
    rows = [(1, "Ａ社", 2023, "g", "x", 5.0), (2, "a%b", 2024, "g", "y", None), (3, "A_社", 2024, "h", "x", 7.0), (4, None, 2024, None, None, 7.0)]
    return spark.createDataFrame(rows, "id long, vendor string, fiscal_year int, category string, agency string, amount double")


@pytest.mark.parametrize("spec, ids", [(search.SearchSpec(), [3, 4, 1, 2]), (search.SearchSpec("a"), [3, 1, 2]), (search.SearchSpec("A社"), [1]), (search.SearchSpec("a_社"), [3]), (search.SearchSpec(years=[2024], agencies=["x"]), [3]), (search.SearchSpec(limit=1), [3])])
def test_search(ledger, spec, ids):
    rows, total = search.search(ledger, spec)
    assert [r.id for r in rows.collect()] == ids and total.first().total >= len(ids)


def test_drill_facets_adaptive(ledger):
    assert search.drill(ledger, {"category": "g", "agency": "y"}).first().id == 2
    assert [r.category for r in search.facet_values(ledger, "category").collect()] == ["g", "h"]
    out = search.adaptive(ledger, ["id", "amount", "none"], ["amount"])
    assert out.columns == ["id", "amount"] and out.where("id = 2").first().amount == 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["category", "agency", "bid_method", "n", "total"]
    assert set(registry.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
