"""Tables of pages, each on a hand-made page."""

from tallybrook.operators import windows
from tallybrook.sources import layouts

WORDS = "file_id string, page int, text string, x0 double, x1 double, top double"


def word(text, x, top, width=10, page=1):
    return ("f", page, text, float(x), float(x + width), float(top))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), WORDS)


def grids(df):
    return {(r.file_id, r.page): (r.tier, r.tables) for r in df.collect()}


def test_islands_join_what_touches(spark):
    df = spark.sql("select array(struct(5D as lo, 6D as hi), struct(0D as lo, 2D as hi), struct(1D as lo, 4D as hi), struct(8D as lo, 9D as hi)) as s, cast(array() as array<struct<lo:double,hi:double>>) as e")
    r = df.select(layouts.islands(df.s, 1.0).alias("a"), layouts.islands(df.s, 0.0).alias("b"), layouts.islands(df.e, 1.0).alias("c")).first()
    assert [tuple(x) for x in r.a] == [(0, 6), (8, 9)] and [tuple(x) for x in r.b] == [(0, 4), (5, 6), (8, 9)] and r.c == []


def test_tiers(spark):
    grid = [word("title over all", 0, 0, 200), word("a", 5, 20), word("b", 50, 20), word("c", 5, 40), word("c2", 17, 41), word("d", 60, 40)]
    lines = [word("one", 0, 0, page=2), word("two", 0, 20, page=2), word("x", 50, 20, page=2), word("three", 0, 40, page=2)]
    column = [word("p", 0, 0, page=3), word("q", 1, 20, page=3)]
    empty = [word(None, 0, 0, page=4), ("g", 1, " ", 0.0, 0.0, 0.0)]
    ruled = spark.createDataFrame([("f", 1, 1, 0, ["z"]), ("h", 1, 0, 1, ["u", None]), ("h", 1, 0, 0, ["t"])], "file_id string, page int, table int, row int, cells array<string>")
    got = grids(layouts.tiered(frame(spark, *grid, *lines, *column, *empty)))
    assert got[("f", 1)] == ("text", [[["title over all", ""], ["a", "b"], ["c c2", "d"]]])
    assert [got[k][0] for k in (("f", 2), ("f", 3), ("f", 4), ("g", 1))] == ["words", "words", "none", "none"]
    both = grids(layouts.tiered(frame(spark, *grid), ruled))
    assert both == {("f", 1): ("ruled", [[["z"]]]), ("h", 1): ("ruled", [[["t"], ["u", None]]])}
    assert layouts.tiered(frame(spark, *grid).limit(0)).count() == 0


def test_table_records(spark):
    head = ["番号 名称", "", "契約 相手方", "契約\n金額", "入札方式", "契約日"]
    body = [["1", "艦艇の修理", "甲社\n東京都\n港区", "1,000 1,100", "一般競争", "R6.4.1"], ["2", "部品", "乙社", "2,000", "〃", None], ["3", "4", "", "5", "", ""], ["5", "無償", "丙", "0", "", ""], ["名", "", "丁", "７", "随意", "2020/3/31"]]
    rows = [("f", 1, 0, i, c) for i, c in enumerate([["注"], head, *body])] + [("g", 1, 0, 0, head), ("k", 1, 0, 0, ["x"]), ("k", 1, 0, 1, ["y"])]
    ruled = spark.createDataFrame(rows, "file_id string, page int, table int, row int, cells array<string>")
    rules = [("名称", "contract_name"), ("相手方", "vendor_name"), ("契約金額", "contract_amount"), ("入札方式", "bid_method"), ("契約日", "contract_date")]
    read = layouts.tiered(frame(spark, word(None, 0, 0)), ruled)
    got = [(r.row, r.contract_name, r.vendor_name, r.vendor_address, r.contract_amount, r.bid_method, r.fiscal_year) for r in layouts.table_records(read, rules, [("一般競争", "一般競争入札"), ("随意", "随意契約")]).orderBy("row").collect()]
    assert got == [(2, "艦艇の修理", "甲社", "東京都 / 港区", 1100, "一般競争入札", 2024), (3, "部品", "乙社", None, 2000, "一般競争入札", None)]
    assert [r.row for r in layouts.table_records(read, rules, [], [2019]).collect()] == [3]


def test_planned_rows_take_the_borders_before_them(spark):
    head = [word("要求元", 300, 100), word("件数", 360, 100), word("納期", 420, 110), word("区分", 480, 90)]
    line = lambda page, org="A": [word("7", 100, 200, page=page), word("55", 200, 200, page=page), word("名", 220, 200, page=page), word(org, 300, 200, page=page), word("9", 356, 200, page=page), word("2022/3/1", 420, 200, page=page)]
    lone = [word("要求元", 280, 20, page=7), word("b", 290, 50, page=7), word("R5.12", 352, 50, page=7)]
    df = frame(spark, *line(-1), *head, *line(1), *line(5), *line(6, "?"), *line(2000, "B z"), *lone, *(("g", *r[1:]) for r in line(9)))
    got = sorted(tuple(r) for r in layouts.planned_rows(df, {"A": "army", "B": "navy", "b": "navy"}).drop("item_name_norm").collect())
    assert got == [
        ("f", 1, 1, "A", "army", "55 名", 9, 15), ("f", 5, 2, "A", "army", "55 名", 9, 15), ("f", 7, 4, "b", "navy", "", None, 12),
        ("f", 2000, 5, "B", "navy", "55 名", None, None),
    ]
    assert layouts.planned_rows(df.limit(0), {}).count() == 0


def test_carried_and_summed_far_equal_plain_windows(spark, monkeypatch):
    monkeypatch.setattr(windows, "RUN", 3)
    rows = [(k, i, (i * 7 + k) % 5 or None) for k in range(3) for i in range(-4, 20) if (i + k) % 3]
    df = spark.createDataFrame(rows, "k int, i int, v int")
    want, last, total = {}, {}, {}
    for k, i, v in rows:
        want[k, i] = (v if v is not None else last.get(k), total.get(k, 0))
        last[k], total[k] = want[k, i][0], want[k, i][1] + (v or 0)
    far = windows.summed_far(windows.carried_far(df, ["k"], "i", "v", "c"), ["k"], "i", "v", "s")
    assert {(r.k, r.i): (r.c, r.s) for r in far.collect()} == want


def test_two_axes_and_ties(spark):
    labels = [word("億円", 0, 1), word("（百万円）", 0, 5), word("一般競争", 100, 20), word("随意契約", 200, 20), word("件数", 0, 50), word("金額", 0, 70)]
    numbers = [word("9", 100, 20), word("3", 150, 60), word("4", 100, 56), word("1,234", 199, 71), word("x5", 200, 50), word("８", 260, 50)]
    methods = [("一般競争", "open"), ("随意", "direct")]
    got = sorted((r.label, r.measure, r.value, r.unit) for r in layouts.two_axis(frame(spark, *labels, *numbers), [("件数", "cases"), ("金額", "amount")], methods).collect())
    assert got == [("amount", "direct", 1234.0, 100), ("cases", "direct", 8.0, 100), ("cases", "open", 4.0, 100)]
    table = sorted((r.method, r.cases, r.amount_100m) for r in layouts.method_table(frame(spark, *labels, *numbers), methods).collect())
    assert table == [("direct", 8, 12.34), ("open", 4, None)]
    assert layouts.two_axis(frame(spark, *labels).where("text <> '件数' and text <> '金額'"), [("件数", "cases")], methods).count() == 0


def summary(spark, *tables):
    rows = [("f", t, i, c) for t, table in enumerate(tables) for i, c in enumerate(table)]
    return {r.label: r.value for r in layouts.yearly_summary(spark.createDataFrame(rows, "file_id string, table int, row int, cells array<string>")).collect()}


def test_yearly_summary(spark):
    assert summary(spark, [["合計", "12"]], [["陸幕", "３,０００"], ["海上・航空", "1"], ["空自", "9億円余り"], ["計", "合計", "1,000,000百万円"]]) == {"total": 10000.0, "army": 3000.0}
    assert summary(spark, [["合計", "6000"], ["陸幕", "5900"], ["陸自", "500"]]) == {"total": 6000.0, "army": 500.0}  # 5,900 is too much, 59 too little
    assert summary(spark, [["陸幕", "4000"], ["海幕", "4000"], ["合計", "6000"]]) == {"total": 6000.0}  # more than the total together
    assert summary(spark, [["陸幕", "4000"]]) == {}


def test_main_items(spark):
    rows = [word("空", 20, 10), word("幕", 30, 10), word("品目", 100, 20), word("輸送機", 100, 30), word("2機", 340, 31), word("184", 400, 30), word("日本", 420, 30), word("電機", 440, 31), word("12", 100, 40), word("内局", 20, 50), word("甲", 100, 60), word("事務機", 100, 70), word("9,9", 400, 70)]
    got = [tuple(r) for r in layouts.main_items(frame(spark, *rows), (60, 330), (330, 390), 395, 80, "幕|内局", "品目", True).select("org", "item_name", "quantity", "amount", "vendor_name").collect()]
    assert got == [("空幕", "輸送機", "2機", 184.0, "日本電機"), ("内局", "事務機", None, 99.0, None)]
    apart = [tuple(r) for r in layouts.main_items(frame(spark, *rows), (60, 330), (330, 390), 395, 80, "幕|内局", "品目", False).select("item_name", "amount", "vendor_name").collect()]
    assert apart == [("輸送機", 184.0, "日本電機"), ("事務機", 99.0, None)]
