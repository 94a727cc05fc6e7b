"""Versions of a table, headed JSON lines, nested HTML, sections of texts, names by form."""

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import linkage, merge, versions
from tallybrook.sources import exports, grids, reports


def test_versions(spark, tmp_path):
    v = versions.Versions(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, "a", 1.5e8), (2, None, 2.0e8)], "id int, k string, amount double")
    with pytest.raises(ValueError):
        v.read()
    assert v.current() is None and v.log().count() == 0
    assert not v.publish(df, "amount", ["k"]) and v.current() is None  # a NULL, and nothing in force yet
    assert v.publish(df, "amount", ["id"])
    first = v.current()["version"]
    assert not v.publish(df.limit(1), "amount") and not v.publish(df.withColumn("amount", F.col("amount") * 2), "amount")
    assert v.current()["version"] == first and v.read().count() == 2
    assert v.publish(v.read().withColumn("k", F.lit("z")), "amount", ["k"]) and v.current()["version"] != first
    assert v.publish(df.limit(1), "amount", same=False) and v.read().count() == 1 and v.read(first).where("k = 'a'").count() == 1
    log = v.log().collect()
    assert [r.accepted for r in log] == [False, True, False, False, True, True] and log[0].nulls == 1 and log[2].rows == 1 and log[3].why.startswith("total")
    assert v.publish(df.limit(0), "amount", same=False) and v.read().count() == 0
    assert merge.protected_swap(v, spark.createDataFrame([], "id int, k string, amount double, seq int"), ["id"], F.col("k") == "a", "seq", "amount")


def test_publishing_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(1000).selectExpr("id", "id * 1.0 AS amount").repartition(2).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)
    df = spark.read.parquet(path)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    v = versions.Versions(spark, str(tmp_path / "t"))
    assert v.publish(df.mapInArrow(counted, df.schema), "amount", ["id"]) and seen.value == 1000


def test_headed_json_lines(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i}é") for i in range(50)], "id int, name string").repartition(3)
    for every in (False, True):
        path = str(tmp_path / f"out{every}")
        exports.jsonl(df, path, '{"year": 2024, "by": "x"}', every)
        assert sorted(map(tuple, grids.jsonl(spark, path, "id int, name string").collect())) == sorted(map(tuple, df.collect()))
        rows = grids.jsonl(spark, path, "id int, name string", "year int, by string").collect()
        assert len(rows) == 50 and all((r.meta is not None and r.meta.year == 2024) == every for r in rows)
    import gzip
    import pathlib

    for name, lines in {"a": ['{"_meta": "{\\"year\\": 1}"}', '{"id": 1}'], "b": ['{"_meta": {"year": 2}}', '{"id": 2}', '{"id": 3}'], "c": ['{"id": 4}'], "d": [], "e": ['{"_meta": "{\\"year\\": 5}"}']}.items():
        with gzip.open(tmp_path / f"{name}.json.gz", "wt") as f:
            f.write("\n".join(lines))
    got = grids.jsonl(spark, str(pathlib.Path(tmp_path) / "*.json.gz"), "id int", "year int").collect()
    assert sorted((r.id, r.meta.year if r.meta else None) for r in got) == [(1, 1), (2, 2), (3, 2), (4, None)]


NESTED = "<table><tr><td>契約金額<td>社名</tr><tr><th>1&nbsp;<b>000</b></th><td>甲<table><tr><td>内</td></tr></table></td></tr><tr><td> </td></tr></table><!-- <table><tr><td>x</td></tr></table> --><script>'<table>'</script><table></table>"


def test_nested_tables(spark):
    pages = [(1, NESTED), (2, "<table><tr><td>a</td></tr><tr><td>a</td></tr><tr><td><table><tr><td>b (PDF:3KB)</td></tr></table></td></tr></table>"), (3, "</tr></table>"), (4, None), (5, "<TABLE><TR><TD>契約金額")]
    got = {}
    for r in grids.html_tables(spark.createDataFrame(pages, "page_id int, html string")).orderBy("page_id", "table", "row").collect():
        got.setdefault(r.page_id, {}).setdefault(r.table, []).append(r.cells)
    assert got == {
        1: {0: [["契約金額 社名", "社名"], ["1 000", "甲 内", "内"], ["内"]], 1: [["内"]]}, 2: {0: [["a"], ["b", "b"], ["b"]]}, 5: {0: [["契約金額"]]},
    }
    depths = {(r.tag, r.depth): r.elements for r in grids.element_depths(spark.createDataFrame([(1, NESTED)], "page_id int, html string"), ["table", "br"]).collect()}
    assert depths == {("table", 0): 2, ("table", 1): 1}


def test_brackets_are_matched():
    page = "<p>a<b>c</p>d</b></i><br><img/>e"
    assert [(x[0], x[1], page[x[3] : x[4]]) for x in grids.elements(page)] == [("p", 0, "a<b>c"), ("b", 1, "c"), ("br", 0, ""), ("img", 0, "")]


def test_sections_and_narratives(spark):
    texts = spark.createDataFrame([("a", "intro B one A two radar C three radar end"), ("b", "nothing"), ("c", "A radar A x"), ("d", None)], "file_id string, text string")
    heads = [(1, "A"), (2, "B"), (3, "C")]
    got = {(r.file_id, r.section): r.body for r in reports.sections(texts, heads).collect()}
    assert got == {("a", 1): "A two radar ", ("a", 2): "B one A two radar ", ("a", 3): "C three radar end", ("c", 1): "A radar A x"}
    words = [("thr\\w+", 3, "three"), ("radar", 2, "R"), ("two", 1, "R"), ("x$", 3, "last"), ("zz", 1, "none")]
    found = sorted(tuple(r) for r in reports.narratives(texts, heads, words).collect())
    assert found == [("a", 2, "R", "radar"), ("a", 3, "three", "three"), ("c", 2, "R", "radar"), ("c", 3, "last", "x")]
    known = spark.createDataFrame([("a", "R")], "file_id string, name string")
    assert reports.narratives(texts, heads, words, known).count() == 3


def test_names_by_form_and_the_latest(spark):
    wanted = spark.createDataFrame([(1, "甲　計画"), (2, " 乙 "), (3, "丙"), (4, None)], "id int, name string")
    known = spark.createDataFrame([("甲　計画", 7), ("甲 計画", 1), ("乙", 5), ("乙", 3)], "name string, v int")
    assert sorted(tuple(r) for r in linkage.by_name_forms(wanted, known, "id", "name", "v").collect()) == [(1, 7, "exact"), (2, 3, "plain")]
    docs = spark.createDataFrame([("radar one", 2020, 1), ("radar two", 2021, 2), ("a radar", 2021, 3), ("a radar", 2021, 9), ("x", None, 4), (None, 2030, 5)], "n string, y int, s int")
    words = spark.createDataFrame([(1, "radar"), (2, "one"), (3, "zz"), (4, None), (5, "")], "id int, w string")
    assert sorted(tuple(r) for r in linkage.latest_like(words, docs, "id", "w", "n", "y", "s").collect()) == [(1, "a radar", 2021, 3), (2, "radar one", 2020, 1)]
