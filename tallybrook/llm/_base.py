"""Helpers shared by the operators: tables, the shared folder, prefix sums, words and shingles in numpy."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that the numpy helpers take at a time.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only in local mode where none is set, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage and survives the loss of executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(left: DataFrame, right: DataFrame, key: str | list[str], count: str, total: int, most: int = 10_000) -> DataFrame:
    """Inner join on the key, of which `right` has each value once, with `count`, the rows of `left` (`total` in all) that have it.

    Values that hold more than 1 / `most` of the rows, so fewer than `most` of them, are broadcast, and their rows stay
    where they are; the others are shuffled.
    """
    bar = max(total // most, 100)
    hot, cold = right.where(F.col(count) > bar), right.where(F.col(count) <= bar)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(rest.join(cold.hint("merge"), key))


def fold(key: Column, of: int) -> Column:
    """crc32 of a key's text form, modulo `of`."""
    return F.crc32(key.cast("string")) % F.lit(of)


def drawn(df: DataFrame, key: str, n: int, most: int, salt: int) -> DataFrame:
    """About `most` of n rows, those of the lowest hash of their key; all of them if there are no more. No sort, no limit: what
    reaches the driver is the sample alone."""
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 40)) < F.lit(int(most / n * (1 << 40))))


def prefix_sums(df: DataFrame, keys: list[str], order: str, value: str, out: str, group: int = 1024) -> DataFrame:
    """Adds the sum of `value` over smaller `order` (an integer column) within `keys`.

    Two levels: sums within runs of `group` consecutive orders, then over the runs' totals, so no window holds a
    whole key's rows: a task has at most `group` of them, or one row for each run.
    """
    run = F.floor(F.col(order) / group)
    df = df.withColumn("_run", run)
    inner = Window.partitionBy(*keys, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = df.groupBy(*keys, "_run").agg(F.sum(value).alias("_total"))
    if not keys:
        outer = Window.partitionBy(F.lit(0)).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, "_run", F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_runs_before"))
    return (
        df.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(runs, [*keys, "_run"])
        .withColumn(out, (F.col(out) + F.col("_runs_before")).cast("long"))
        .drop("_run", "_runs_before")
    )


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `limit` bytes of text; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > limit:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += int(size)
    if at < len(sizes):
        yield batch.slice(at)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array, end to end, and where each text begins and ends; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, at, data = texts.buffers()
    off = np.frombuffer(at, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.empty(0, np.uint8)
    return raw, off - off[0]


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a sum or product count."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def begins_of(inner: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where words begin, given which bytes belong to words."""
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    head = off[:-1][off[:-1] < off[1:]]
    begins[head] = inner[head]
    return np.flatnonzero(begins)


def words_of(raw: np.ndarray, off: np.ndarray, inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space (or between bytes outside `inner`): a 64-bit hash and the length in bytes of each, and the number of words before each text."""
    n = len(raw)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    inner = ~SPACE[raw] if inner is None else inner
    start = begins_of(inner, off)
    counts = np.searchsorted(start, off)
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64), counts
    kept = np.flatnonzero(inner)
    rank = np.searchsorted(kept, start)
    length = np.diff(np.append(rank, len(kept)))
    power = np.cumprod(np.full(int(length.max()), ODD, np.uint64))
    at = np.arange(len(kept)) - np.repeat(rank, length)
    sums = np.add.reduceat((raw[kept].astype(np.uint64) + np.uint64(1)) * power[at], rank)
    return mix(sums + length.astype(np.uint64)), length, counts


def shingles_of(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of every `size` words in a row of each text, sorted, and where each text's set begins.

    A text of fewer words has one shingle of all of them; a text with no word has none.
    """
    n, per = len(words), np.diff(counts)
    doc = np.repeat(np.arange(len(per)), per)
    total = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size if n >= size else 0):
        total = total * ODD + words[k : n - size + 1 + k]
    inside = doc[: n - size + 1] == doc[size - 1 :] if n >= size else np.empty(0, bool)
    hashes, owner = mix(total[inside]), doc[: len(inside)][inside]
    short = np.flatnonzero((per > 0) & (per < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = per[short] > k
            whole[has] = whole[has] * ODD + words[counts[short[has]] + k]
        hashes, owner = np.append(hashes, mix(whole + per[short].astype(np.uint64))), np.append(owner, short)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(per) + 1))
