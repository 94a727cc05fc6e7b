"""The most alike of any number of passages for each vector: products of blocks, whose best values are merged.

Vectors and passages are packed into blocks of rows; each pair of blocks is one matrix product in a task and gives one row a
vector, so what moves is blocks, and neither side is collected or put in a plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block.
BLOCK = 1024


def _packed(df: DataFrame, value: str, vector: str, out: str) -> DataFrame:
    """Blocks (list of `value`, flat list of numbers) of the partition's rows; vectors that are null or hold a null take no part."""
    kind = df.schema[value].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(at, BLOCK)
                flat = rows.column(1).flatten()
                lists = [pa.ListArray.from_arrays([0, len(values)], values) for values in (rows.column(0), flat)]
                yield pa.RecordBatch.from_arrays(lists, [f"{out}_ids", f"{out}_flat"])

    good = df.where(F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull())).select(value, F.col(vector).cast("array<double>"))
    return good.mapInArrow(run, f"{out}_ids array<{kind}>, {out}_flat array<double>")


def nearest(vectors: DataFrame, passages: DataFrame, key: str, vector: str, label: str, least: float) -> DataFrame:
    """(key, label, confidence) of the passage of the highest inner product, if its rounded value is at least so much; of equals, the last label.

    All vectors have one length. Each key stands once; passages, counted first, make as many blocks as they need.
    """
    blocks = max(1, -(-passages.count() // BLOCK))
    dealt = passages if blocks == 1 else passages.repartition(blocks, label)
    parts = _packed(dealt.coalesce(1) if blocks == 1 else dealt, label, vector, "p").withColumn("block", F.pmod(F.xxhash64("p_ids"), F.lit(blocks)))
    many = _packed(vectors, key, vector, "v").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    kinds = [vectors.schema[key].dataType.simpleString(), passages.schema[label].dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = (batch.column(c)[i].values for c in ("v_ids", "p_ids"))
                x, y = (batch.column(c)[i].values.to_numpy() for c in ("v_flat", "p_flat"))
                scores = x.reshape(len(ids), -1) @ y.reshape(len(labels), -1).T
                names = labels.to_pylist()
                order = sorted(range(len(names)), key=lambda j: (names[j] is not None, names[j]), reverse=True)  # of equals the last label is met first
                best = np.array(order)[np.argmax(scores[:, order], axis=1)]
                yield pa.RecordBatch.from_arrays([ids, labels.take(pa.array(best)), pa.array(scores[np.arange(len(ids)), best])], ["key", "label", "score"])

    pairs = many.join(parts, "block").select("v_ids", "v_flat", "p_ids", "p_flat").mapInArrow(run, f"key {kinds[0]}, label {kinds[1]}, score double")
    if blocks > 1:
        pairs = pairs.groupBy("key").agg(F.max(F.struct("score", "label")).alias("r")).select("key", "r.*")
    out = pairs.select(F.col("key").alias(key), F.col("label").alias(label), F.round("score", 4).alias("confidence"))
    return out.where(F.col("confidence") >= least)
