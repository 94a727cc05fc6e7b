"""The crawl's coverage grid: which cell of agency, year, month and kind has a source, and how cells get filled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import dates, text
from tallybrook.operators import linkage


def reconciled(grid: DataFrame, loaded: DataFrame) -> DataFrame:
    """The grid with `dash` cells turned to `filled_new` where their url was loaded: by exact url, archived page, file name.

    grid: id, url, status; loaded: source_url.
    """
    seen = loaded.select(F.col("source_url").alias("exact"), text.unwrapped_url(F.col("source_url")).alias("page"), F.nullif(F.lower(text.basename(text.unwrapped_url(F.col("source_url")))), F.lit("")).alias("file"), F.lit(1).alias("hit")).distinct()
    cells = grid.withColumns({"_exact": F.col("url"), "_page": text.unwrapped_url(F.col("url")), "_file": F.nullif(F.lower(text.basename(text.unwrapped_url(F.col("url")))), F.lit(""))})
    found = linkage.multi_strategy(cells, seen, [("_exact", "exact"), ("_page", "page"), ("_file", "file")], "hit")
    new = (F.col("status") == "dash") & F.col("hit").isNotNull()
    return found.withColumn("status", F.when(new, "filled_new").otherwise(F.col("status"))).select(*grid.columns, F.regexp_replace("strategy", "^_", "").alias("strategy"))


def rolling_cells(files: DataFrame) -> DataFrame:
    """(file, agency, fiscal_year, month) that a cumulative file covers: the months its name spells out, else those of its dates.

    files: file, agency, fiscal_year, first, last (dates). A file counts as cumulative if its name lists months or its
    dates span 60 days.
    """
    digits = text.trailing_digits(F.col("file"))
    named = F.when(F.length(digits) >= 6, text.rolling_months(digits))
    span = F.when(F.datediff("last", "first") >= 60, dates.months_covered(F.col("first"), F.col("last"), F.col("fiscal_year")))
    months = F.coalesce(F.when(F.size(named) > 0, named), span)
    return files.select("file", "agency", "fiscal_year", F.explode(months).alias("month"))


def expanded(grid: DataFrame, cells: DataFrame) -> DataFrame:
    """Only `dash` cells take a cumulative file."""
    one = cells.groupBy("agency", "fiscal_year", "month").agg(F.min("file").alias("_file"))
    out = grid.join(one, ["agency", "fiscal_year", "month"], "left")
    fill = (F.col("status") == "dash") & F.col("_file").isNotNull()
    return out.withColumns({"status": F.when(fill, "filled_new").otherwise(F.col("status")), "filename": F.when(fill, F.col("_file")).otherwise(F.col("filename"))}).select(grid.columns)


def header_audit(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Cells whose file says another kind or method than the grid."""
    h = headers.select("filename", F.col("category").alias("found_category"), F.col("bid_method").alias("found_bid"))
    return grid.join(h, "filename").where(~F.col("category").eqNullSafe(F.col("found_category")) | ~F.col("bid_method").eqNullSafe(F.col("found_bid")))


def rates(grid: DataFrame, keys: list[str]) -> DataFrame:
    """Cells, those filled, and their share."""
    done = F.count_if(F.col("status").isin("filled", "filled_new"))
    return grid.groupBy(*keys).agg(F.count("*").alias("cells"), done.alias("filled"), F.round(F.try_divide(done, F.count("*")), 4).alias("rate"))


def row_state(status: Column, new_flag: Column, missing_flag: Column, url: Column) -> Column:
    return F.when(F.coalesce(missing_flag, F.lit(0)) == 1, "404").when((status == "filled") & (F.coalesce(new_flag, F.lit(0)) == 1), "filled_new").when(status.isin("filled", "filled_new"), status).when(F.coalesce(url, F.lit("")) != "", "pending").otherwise("dash")


def facets(df: DataFrame, chosen: dict[str, list]) -> DataFrame:
    """Rows whose values are among the chosen; a blank passes, and no choice is no filter."""
    for c, values in chosen.items():
        if values:
            df = df.where(F.col(c).isin(values) | (F.col(c) == ""))
    return df
