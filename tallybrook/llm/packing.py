"""Packing (operator 8): cost-balanced packing of documents into sequences.

Documents are taken as they stream through a task, in groups of about `group_tokens`. In a group, a document's full
stretches of `length` tokens are sequences of their own; what remains of each goes, longest first, to the sequence of
the lowest cost that has room, where a piece of n tokens costs linear * n + quadratic * n * n. The room of a group's
sequences is its tokens exactly: `length` each, and powers of two for what is left, so nothing is padded. A document
that fits nowhere is cut at the sequence with the most room. Nothing is shuffled: a group is a part of one input split.

Cases: null and empty texts are documents of the end id alone; very long texts are cut into full sequences and a
rest; of sequences with equal cost the first is taken, of documents of equal length the first; rows of equal doc_id are packed each on their own; an
empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import pieces, table
from ._encode import encoder

LENGTH, GROUP_TOKENS = 4096, 1_000_000
#: Costs of a token, and of a pair of tokens that attend to each other.
LINEAR, QUADRATIC = 1.0, 1 / 8192
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def assign(sizes: np.ndarray, length: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one group."""
    out, n_seq, rest = [], 0, []
    for doc, n in enumerate(sizes.tolist()):
        for start in range(0, n - n % length, length):
            out.append((doc, start, length, n_seq, 0))
            n_seq += 1
        if n % length:
            rest.append((n % length, doc, n - n % length))
    total = sum(r[0] for r in rest)
    room = np.array([length] * (total // length) + [1 << b for b in range(length.bit_length(), -1, -1) if total % length >> b & 1], np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    rest.sort(key=lambda r: (-r[0], r[1]))
    for n, doc, start in rest:
        while n:
            fits = np.flatnonzero(room - used >= n)
            k = int(fits[np.argmin(cost[fits])]) if len(fits) else int(np.argmax(room - used))
            m = min(n, int(room[k] - used[k]))
            out.append((doc, start, m, n_seq + k, int(used[k])))
            used[k] += m
            cost[k] += linear * m + quadratic * m * m
            n, start = n - m, start + m
    return out


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, length: int = LENGTH, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece; sequence ids are unique over the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, held, total = TaskContext.get().partitionId() << 36, [], 0

        def close() -> pa.RecordBatch:
            nonlocal base
            ids = np.concatenate([x[1] for x in held])
            sizes = np.concatenate([np.diff(x[2]) for x in held])
            at = np.cumsum(sizes) - sizes
            doc, start, size, seq, offset = (np.array(x, np.int64) for x in zip(*assign(sizes, length), strict=True))
            first = at[doc] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(first.tolist(), size.tolist(), strict=True)]
            keys = pa.concat_arrays([x[0] for x in held]).take(pa.array(doc))
            columns = [keys, start, size, pa.array(crc, pa.int64()), sizes[doc], base + seq, offset]
            base += int(seq.max()) + 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in PIECES.split(", ")])

        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, off = encoder(tokenizer_file, end_id).encode(piece.column("text"))
                held.append((piece.column("doc_id").cast(pa.int64()), ids, off))
                total += len(ids)
                if total >= group_tokens:
                    yield close()
                    held, total = [], 0
        if held:
            yield close()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2)


def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op8_cost_balanced_packing": op8_cost_balanced_packing}
SQL: dict[str, str] = {}
