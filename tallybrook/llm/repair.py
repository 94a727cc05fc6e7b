"""Token-id output (operator 1): Re-Pair grammar compression of shards of token ids.

A shard is a run of documents in ascending doc_id order. Its file row holds the shard's alphabet (distinct ids), its
rules (pairs of symbols; symbol numbers go on after the alphabet), each rule's expansion length, and the symbols of all
documents end to end. No rule spans two documents, so a document, or a range of its tokens, is decoded alone.

Rounds: count pairs of neighbouring symbols, give a nonterminal to each of the most frequent ones, replace them where
no better pair overlaps, and go on over the shorter row of symbols until no pair stands LEAST_COUNT times without
overlap. The first rounds count pairs in a table of hashes, in which a cell stands for one of its pairs; once such a round
replaces little, pairs are counted by sorting, so that none is missed. After that a pair can only be frequent where one was
before, or beside a new symbol, so later rounds look there alone.

Cases: null and empty texts are documents of the end id alone; very long texts are encoded and compressed whole; pairs that
stand equally often are replaced in the order of their symbols; rows of equal doc_id are each kept, in the order of their text; rows with a null doc_id come first; an empty table gives no rows. Other columns of the input play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import new_path, pieces, prefix_sums, table
from ._encode import encoder

#: A shard is closed when it has so many tokens.
SHARD_TOKENS = 4_000_000
RULES_A_ROUND, LEAST_COUNT = 3000, 8
HASH_BITS = 20
#: Share of the symbols that a round by hashes must replace for another to follow.
WORTH = 0.03
SHARD = "shard long, width int, n_tokens long, doc_ids binary, doc_nulls binary, doc_symbols binary, doc_tokens binary, alphabet binary, rules binary, lengths binary, symbols binary"
DOCS = "doc_id long, shard long, local long, n_tokens long, ids_crc32 long"


def compress(ids: np.ndarray, off: np.ndarray, rules_a_round: int = RULES_A_ROUND, least: int = LEAST_COUNT):
    """Alphabet, rules (n, 2), symbols, and where each document's symbols begin."""
    alphabet = np.flatnonzero(np.bincount(ids)).astype(np.uint32) if len(ids) else np.empty(0, np.uint32)
    number = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.uint32)
    number[alphabet] = np.arange(len(alphabet))
    s, at, rules, n_rules, by_hash, places = number[ids], off.copy(), [], 0, True, None
    while len(s) >= 2 * least:
        held, kind = _by_hash(s, at, rules_a_round, least) if by_hash else _by_sorting(s, at, places, least)
        pos, kind = _apart(held, kind)
        count = np.bincount(kind)
        often = count >= least
        if not often.any():
            if not by_hash:
                break
            by_hash = False
            continue
        place = np.empty(len(count), np.int64)  # a pair's rank: by its count, no two alike
        place[np.argsort(count, kind="stable")] = np.arange(len(count))
        good = often[kind]
        pos, kind = pos[good], kind[good]
        rank = place[kind]
        touching = pos[1:] == pos[:-1] + 1
        lose = np.zeros(len(pos), bool)
        lose[1:] |= touching & (rank[:-1] > rank[1:])
        lose[:-1] |= touching & (rank[1:] > rank[:-1])
        pos, kind = pos[~lose], kind[~lose]
        used = np.bincount(kind, minlength=len(count)) >= least  # the highest rank loses nowhere, so one is left
        good = used[kind]
        pos, kind = pos[good], kind[good]
        first = np.empty(len(count), np.int64)
        first[kind[::-1]] = pos[::-1]
        example = first[used]
        rules.append(np.stack([s[example], s[example + 1]], 1))
        symbol = (np.cumsum(used) - 1 + len(alphabet) + n_rules).astype(np.uint32)
        n_rules += int(used.sum())
        s[pos] = symbol[kind]
        keep = np.ones(len(s), bool)
        keep[pos + 1] = False
        s = s[keep]
        at = at - np.searchsorted(pos, at)
        if by_hash:
            by_hash = len(pos) >= WORTH * len(s)
        else:
            new = pos - np.arange(len(pos))
            held = held[np.searchsorted(pos + 1, held, "right") == np.searchsorted(pos + 1, held)]  # not taken into a symbol
            near = np.zeros(len(s) + 1, bool)
            near[new] = near[new - 1] = near[held - np.searchsorted(pos + 1, held)] = True
            places = np.flatnonzero(near[: max(len(s) - 1, 0)])
    return alphabet, np.concatenate(rules) if rules else np.empty((0, 2), np.uint32), s, at


def _within(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which places begin a pair of one document."""
    out = np.ones(len(s) - 1, bool)
    out[at[(at > 0) & (at < len(s))] - 1] = False
    return out


def _cells(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    cell = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)
    return (cell ^ (cell >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - HASH_BITS)


def _by_hash(s: np.ndarray, at: np.ndarray, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and kinds of frequent pairs: one pair of each of the fullest cells."""
    cell = _cells(s[:-1], s[1:])
    counts = np.bincount(cell, minlength=1 << HASH_BITS)
    bar = max(least, int(np.partition(counts, -min(most, len(counts)))[-min(most, len(counts))]))
    pos = np.flatnonzero((counts >= bar)[cell] & _within(s, at))
    c = cell[pos]
    example = np.zeros(1 << HASH_BITS, np.int64)
    example[c[::-1]] = pos[::-1]
    same = (s[pos] == s[example[c]]) & (s[pos + 1] == s[example[c] + 1])
    pos, c = pos[same], c[same]
    kind = np.zeros(1 << HASH_BITS, np.int64)
    kind[c] = 1
    return pos, (np.cumsum(kind) - 1)[c]


def _by_sorting(s: np.ndarray, at: np.ndarray, places: np.ndarray | None, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and kinds of every frequent pair, of those that begin at `places` (None: anywhere)."""
    if places is None:
        pos = np.flatnonzero(_within(s, at))
    else:
        pos = places[_within(s, at)[places]]
    cell = _cells(s[pos], s[pos + 1])
    pos = pos[(np.bincount(cell, minlength=1 << HASH_BITS) >= least)[cell]]  # no frequent pair is in a cell of fewer
    kind, pairs = pd.factorize(s[pos].astype(np.uint64) << np.uint64(32) | s[pos + 1])
    often = np.flatnonzero(np.bincount(kind) >= least)
    number = np.full(len(pairs), -1)
    number[often[np.argsort(pairs[often])]] = np.arange(len(often))  # by symbols: by place, neighbours would be ranked in a row, and rounds be many
    kind = number[kind]
    return pos[kind >= 0], kind[kind >= 0]


def _apart(pos: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without every second one of a row of equal pairs that overlap, as in a run of one symbol."""
    again = np.zeros(len(pos), bool)
    again[1:] = (pos[1:] == pos[:-1] + 1) & (kind[1:] == kind[:-1])
    if not again.any():
        return pos, kind
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(pos))))
    even = (np.arange(len(pos)) - head) % 2 == 0
    return pos[even], kind[even]


def lengths_of(n_base: int, rules: np.ndarray) -> np.ndarray:
    """How many ids each symbol stands for."""
    out = np.ones(n_base + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        out[n_base + i] = out[a] + out[b]
    return out


def expansions(alphabet: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of every symbol end to end, and where each symbol's begin."""
    at = np.concatenate([[0], np.cumsum(lengths)])
    flat, n = np.empty(at[-1], np.uint32), len(alphabet)
    flat[:n] = alphabet
    for i, (a, b) in enumerate(rules.tolist()):
        k, m = at[n + i], lengths[a]
        flat[k : k + m] = flat[at[a] : at[a] + m]
        flat[k + m : at[n + i + 1]] = flat[at[b] : at[b + 1]]
    return flat, at[:-1]


def expand(symbols: np.ndarray, flat: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    size = lengths[symbols]
    first = np.cumsum(size) - size
    return flat[np.repeat(at[symbols] - first, size) + np.arange(size.sum())]


class Shard:
    """One row of a file, decoded as needed."""

    def __init__(self, row: dict):
        kind = np.uint16 if row["width"] == 2 else np.uint32
        self.doc_ids, self.doc_nulls = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["doc_nulls"], bool)
        self.doc_symbols, self.doc_tokens = np.frombuffer(row["doc_symbols"], np.int64), np.frombuffer(row["doc_tokens"], np.int64)
        self.alphabet, self.rules = np.frombuffer(row["alphabet"], np.uint32), np.frombuffer(row["rules"], np.uint32).reshape(-1, 2)
        self.symbols = np.frombuffer(row["symbols"], kind)
        self.lengths = np.concatenate([np.ones(len(self.alphabet), np.int64), np.frombuffer(row["lengths"], np.uint32).astype(np.int64)])

    def ids(self) -> np.ndarray:
        return expand(self.symbols, *expansions(self.alphabet, self.rules, self.lengths), self.lengths)

    def _symbol(self, symbol: int) -> list[int]:
        out, todo = [], [symbol]
        while todo:
            x = todo.pop()
            if x < len(self.alphabet):
                out.append(int(self.alphabet[x]))
            else:
                todo += self.rules[x - len(self.alphabet)].tolist()[::-1]
        return out

    def tokens(self, doc: int, lo: int = 0, hi: int | None = None) -> list[int]:
        """Tokens lo to hi of the shard's doc-th document; expands only the symbols that they touch."""
        own = self.symbols[self.doc_symbols[doc] : self.doc_symbols[doc + 1]]
        ends = np.cumsum(self.lengths[own])
        last = int(ends[-1]) if len(ends) else 0
        hi = last if hi is None else min(hi, last)
        a, b = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(ends, hi))
        ids = [i for x in own[a : b + 1].tolist() for i in self._symbol(x)]
        skip = lo - (int(ends[a - 1]) if a else 0)
        return ids[skip : skip + hi - lo] if hi > lo else []


def write_shards(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes every text and writes Re-Pair shards, in ascending doc_id order, as Parquet rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, held, total = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate([x[1] for x in held])
            off = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[2]) for x in held]))]).astype(np.int64)
            alphabet, rules, s, at = compress(ids, off)
            n = len(alphabet)
            width = 2 if n + len(rules) <= 65_536 else 4
            col = pa.concat_arrays([x[0] for x in held])
            row = {
                "shard": (part << 24) + seq, "width": width, "n_tokens": len(ids), "doc_ids": pc.fill_null(col, 0).to_numpy(zero_copy_only=False).tobytes(), "doc_nulls": pc.is_null(col).to_numpy(zero_copy_only=False).tobytes(),
                "doc_symbols": at.tobytes(), "doc_tokens": off.tobytes(), "alphabet": alphabet.tobytes(), "rules": rules.astype(np.uint32).tobytes(), "lengths": lengths_of(n, rules)[n:].astype(np.uint32).tobytes(), "symbols": s.astype(np.uint16 if width == 2 else np.uint32).tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=SCHEMA)

        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, off = encoder(tokenizer_file, end_id).encode(piece.column("text"))
                held.append((piece.column("doc_id").cast(pa.int64()), ids, off))
                total += len(ids)
                if total >= shard_tokens:
                    yield close()
                    seq, held, total = seq + 1, [], 0
        if held:
            yield close()

    SCHEMA = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in SHARD.split(", "))])
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Decodes the files: doc_id, start, n_tokens, ids_crc32 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard = Shard(row)
                ids, off = shard.ids(), shard.doc_tokens
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, mask=shard.doc_nulls), pa.array([row["shard"]] * n, pa.int64()), pa.array(off[:-1]), pa.array(np.diff(off)), pa.array(crc, pa.int64())], ["doc_id", "shard", "local", "n_tokens", "ids_crc32"])

    shards = spark.read.parquet(path)
    starts = prefix_sums(shards.select("shard", F.col("n_tokens").alias("_n")), [], "shard", "_n", "_start", 1 << 24).select("shard", "_start")
    return shards.mapInArrow(run, DOCS).join(starts, "shard").select("doc_id", (F.col("_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def op1_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "repair")
    write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 0)
    return read_documents(spark, path)


QUERIES = {"op1_repair_tokens": op1_repair_tokens}
SQL: dict[str, str] = {}
