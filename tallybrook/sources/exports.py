"""Sinks: partitioned CSV, gzipped JSON lines with a header object, the frames of workbooks, snapshots of the expected state."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def csv_by_category(df: DataFrame, path: str, category: str) -> None:
    df.write.mode("overwrite").option("header", True).partitionBy(category).csv(path)


def jsonl(df: DataFrame, path: str, meta: str, every_file: bool = False) -> None:
    """Gzipped JSON lines. The header is an object of its own, with the one field _meta. It is alone in the first part (a union
    keeps the order of its sides' partitions), or with `every_file` the first line of each file that has rows; readers drop it by
    that field."""
    session, lines = df.sparkSession, df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    if every_file:
        head = json.dumps({"_meta": meta}, ensure_ascii=False)

        def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = True
            for batch in batches:
                if first and batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([head])], ["value"])
                    first = False
                yield batch

        lines = lines.mapInArrow(headed, "value string")
    else:
        lines = session.range(1, numPartitions=1).select(F.to_json(F.struct(F.lit(meta).alias("_meta"))).alias("value")).unionByName(lines)
    lines.write.mode("overwrite").option("compression", "gzip").text(path)


def csv_download(df: DataFrame, path: str, order: list, most: int = 50) -> None:
    """One CSV file of the first rows, with the mark that tells spreadsheets that it is UTF-8."""
    first = df.columns[0]
    df.orderBy(*order).limit(most).coalesce(1).withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("header", True).csv(path)


def sheets(df: DataFrame, blocks: dict[str, list[str]], amount: str, order: list, most: int = 100_000) -> dict[str, DataFrame]:
    """The frames of a workbook by sheet: one block of rows, amount and mean for each list of keys, the detail up to the sheet's
    cap, and the notice of how many rows there are."""
    total = lambda keys: df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(amount).alias("amount"), F.avg(amount).alias("mean")).orderBy(F.desc_nulls_last("amount"), *keys)
    detail, notice = capped(df, order, most)
    return {name: total(keys) for name, keys in blocks.items()} | {"detail": detail, "notice": notice}


def schemas(frames: dict[str, DataFrame], indexes: dict[str, tuple[str, list[str]]]) -> list[str]:
    """Statements that build the tables and then their indexes, each by name."""
    tables = [f"CREATE TABLE {name} ({', '.join(f'{f.name} {f.dataType.simpleString().upper()}' for f in frames[name].schema)})" for name in sorted(frames)]
    return tables + [f"CREATE INDEX {name} ON {indexes[name][0]} ({', '.join(indexes[name][1])})" for name in sorted(indexes)]


def snapshot(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Rows and amounts of each cell: what a later rebuild is held against."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(amount).alias("amount"))


def capped(df: DataFrame, order: list, most: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """The first rows for a sheet, and a one-row notice of how many there are: the cap is the sheet's, not the query's."""
    return df.orderBy(*order).limit(most), df.agg(F.count("*").alias("rows"), (F.count("*") > most).alias("cut"))
