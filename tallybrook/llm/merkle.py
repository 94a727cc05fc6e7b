"""Merkle dataset manifest (operator 13).

Each row's digest is a leaf; a language's leaves, in order of doc_id, form a tree, and the languages' roots form one above
them. Trees are built from the leaves up by events: a node's digest arrives at its partial parent, which waits until it has
as many children as its place says (the arity, or what is left of the level for the last one) and then emits its own digest.

Leaves are range-partitioned by (lang, doc_id) and packed into chunks of a block's size, since a block's leaves are mostly
neighbours; sums of the chunks' lengths give each leaf its index. Blocks that one task holds whole are resolved there; the
parts of others, the frontier, are shuffled to their block. A block gives one node of the next round, whose blocks are
formed by index alone, until each tree is a single node. Then links run back down: each round's blocks, with the siblings
above them, give their children's siblings, and the leaves fold theirs into proofs.

Bounds: a row here is a block of at most BLOCK leaves (about 0.6 MB), a round has 1 / BLOCK of the rows of the one before,
and no key holds more than a block. Languages may be many: their roots go through the same rounds.

Cases: null fields count as '-', so they differ from empty ones; null and empty languages are two languages, null first;
null doc_ids come first in their language; equal doc_ids are ordered by leaf, and equal leaves, which are rows alike, may
change places; very long texts are hashed whole; one row is a tree of its own, whose root is its leaf; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._base import stored, table
from .resampling import CRC_SQL, crc_sql

ARITY = 2
#: Leaves of a block at most; a power of the arity, the largest within it, is taken.
BLOCK = 4096
#: About how many leaves a range task sorts.
RANGE = 1 << 17
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(fields: dict[str, Column]) -> Column:
    """sha256 of the fields in turn, each by its length in bytes and its value, or '-'."""
    told = []
    for column in fields.values():
        value = column.cast("string")
        told.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*told), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """lang, doc_id, leaf and, for rows that the tampering test picks, the leaf with n_chars one more."""
    fields = {c: F.col(c) for c in FIELDS}
    picked = F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0
    tampered = F.when(picked & F.col("n_chars").isNotNull(), leaf_of(fields | {"n_chars": F.col("n_chars") + 1}))
    return docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), leaf_of(fields).alias("leaf"), tampered.alias("tampered"))


def _levels(size: int, block: int, arity: int) -> int:
    """Levels that a block's leaves rise in one round: to the block's one node, or until a smaller tree is a single node."""
    n, levels = min(size, block), 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


class Combiner:
    """Partial parents of one block: an arriving child completes its parent when it is the last one missing."""

    def __init__(self, count: int, levels: int, arity: int):
        self.arity, self.sizes = arity, [count]
        for _ in range(levels):
            self.sizes.append(-(-self.sizes[-1] // arity))
        self.partial: dict[tuple[int, int], list[str | None]] = {}
        self.missing: dict[tuple[int, int], int] = {}
        self.nodes: list[list[str]] = [[""] * n for n in self.sizes]

    def arrive(self, level: int, place: int, value: str) -> None:
        """`place` is within the block; at the top level the node waits for the next round."""
        self.nodes[level][place] = value
        while level + 1 < len(self.sizes):
            parent = place // self.arity
            key, wide = (level + 1, parent), min(self.arity, self.sizes[level] - parent * self.arity)
            if wide > 1:
                held = self.partial.setdefault(key, [None] * wide)
                held[place - parent * self.arity] = value
                self.missing[key] = self.missing.get(key, wide) - 1
                if self.missing[key]:
                    return
                value = "".join(self.partial.pop(key))
            value, level, place = digest(value), level + 1, parent
            self.nodes[level][place] = value

    def siblings(self, place: int) -> list[tuple[str, str]]:
        """What stands before and after the node's ancestors among their parents' children, level by level."""
        out = []
        for level in range(len(self.sizes) - 1):
            a = place - place % self.arity
            row = self.nodes[level]
            out.append(("".join(row[a:place]), "".join(row[place + 1 : a + self.arity])))
            place //= self.arity
        return out


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, one block's objects at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _built(digests: list[str], levels: int, arity: int) -> Combiner:
    tree = Combiner(len(digests), levels, arity)
    for i, d in enumerate(digests):
        tree.arrive(0, i, d)
    return tree


def packed(rows: DataFrame, tree: list[str], order: list[str], carried: list[str], block: int) -> DataFrame:
    """Chunks of at most `block` neighbours in the order within a tree: the tree's keys, `part`, `chunk`, and a list of structs `items`."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE))
    keys = [F.col(c).asc_nulls_first() for c in (*tree, *order, "_row")]
    names = [*tree, "part", "chunk", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, held, of = TaskContext.get().partitionId(), 0, [], None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([v], t) for v, t in zip(of, kinds, strict=True)), pa.array([part]), pa.array([chunk]), pa.array([held], pa.list_(struct))], names)

        for batch in batches:
            kinds, struct = [batch.schema.field(c).type for c in tree], pa.struct([batch.schema.field(c) for c in carried])
            heads = list(zip(*(batch.column(c).to_pylist() for c in tree), strict=True)) if tree else [()] * batch.num_rows
            items = batch.select(carried).to_pylist()
            for head, value in zip(heads, items, strict=True):
                if held and (head != of or len(held) == block):
                    yield out()
                    chunk, held = chunk + 1, []
                of = head
                held.append(value)
        if held:
            yield out()

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in tree]
    kind = rows.select(F.struct(*carried).alias("i")).schema[0].dataType.simpleString()
    ranged = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(*dict.fromkeys([*tree, *carried]))
    return stored(ranged.mapInArrow(run, ", ".join([*fields, "part long", "chunk long", f"items array<{kind}>"])), "chunks")


def blocks_of(chunks: DataFrame, tree: list[str], block: int) -> DataFrame:
    """The tree's keys, its `size`, the number of the block and its `items`, all of them in order."""
    before = Window.partitionBy(*tree, F.lit(0)).orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    lengths = chunks.select(*tree, "part", "chunk", F.size("items").cast("long").alias("length"))
    # chunks of a tree are N / BLOCK rows of five numbers: first summed by part, so that a window holds a row a part
    parts = lengths.groupBy(*tree, "part").agg(F.sum("length").alias("length")).withColumn("chunk", F.lit(0))
    whole = Window.partitionBy(*tree, F.lit(0))
    parts = parts.select(*tree, "part", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("_before"), F.sum("length").over(whole).alias("size"))
    within = Window.partitionBy(*tree, "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = lengths.select(*tree, "part", "chunk", F.coalesce(F.sum("length").over(within), F.lit(0)).alias("_in_part"))
    places = _joined(places, parts, [*tree, "part"]).withColumn("first", F.col("_before") + F.col("_in_part"))
    chunks = _joined(chunks, places.select(*tree, "part", "chunk", "first", "size"), [*tree, "part", "chunk"])
    room = (F.lit(block) - F.col("first") % block).cast("int")
    cut = F.array(
        F.struct(F.col("first").alias("first"), F.slice("items", F.lit(1), room).alias("items")),
        F.struct((F.col("first") + room).alias("first"), F.slice("items", room + 1, F.lit(block)).alias("items")),
    )
    pieces = chunks.select(*tree, "size", F.explode(cut).alias("p")).where(F.size("p.items") > 0)
    pieces = pieces.select(*tree, "size", F.floor(F.col("p.first") / block).alias("block"), "p.first", "p.items")
    full = F.least(F.lit(block).cast("long"), F.col("size") - F.col("block") * block)
    whole = pieces.where(F.size("items") == full).drop("first")
    frontier = pieces.where(F.size("items") < full).groupBy(*tree, "size", "block").agg(F.sort_array(F.collect_list(F.struct("first", "items"))).alias("parts"))
    return whole.unionByName(frontier.select(*tree, "size", "block", F.flatten(F.transform("parts", lambda p: p["items"])).alias("items")))


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys meet; right's keys are unique. Spark picks the plan by the tables' sizes."""
    right = right.select(*(F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns))
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(right, on).drop(*(f"_r_{c}" for c in keys))


def rounds_of(leaves: DataFrame, tree: list[str], block: int, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks (leaves first) and each tree's root. leaves: blocks whose items have a field `leaf`."""
    rounds, roots, level = [], None, leaves
    while True:
        level = stored(level, "round")
        keys = ", ".join(f"`{c}` {level.schema[c].dataType.simpleString()}" for c in tree)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tops = [_built([i["leaf"] for i in r["items"]], _levels(r["size"], block, arity), arity).nodes[-1][0] for r in _rows(batch.select(["size", "items"]))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*tree, "size", "block")), pa.array(tops, pa.string())], [*tree, "size", "block", "leaf"])

        keep = level.select(*tree, "size", "block", F.transform("items", lambda i: F.struct(i["leaf"].alias("leaf"))).alias("items"))
        nodes = stored(keep.mapInArrow(run, f"{keys}{', ' if keys else ''}size long, block long, leaf string"), "nodes")
        rounds.append(level)
        done = nodes.where(F.col("size") <= block).select(*tree, "leaf")
        roots = done if roots is None else roots.unionByName(done)
        rest = nodes.where(F.col("size") > block)
        if rest.isEmpty():
            return rounds, roots
        size = F.ceil(F.col("size") / block).cast("long")
        grouped = rest.groupBy(*tree, size.alias("_size"), F.floor(F.col("block") / block).alias("_block")).agg(F.sort_array(F.collect_list(F.struct("block", "leaf"))).alias("items"))
        level = grouped.select(*tree, F.col("_size").alias("size"), F.col("_block").alias("block"), F.transform("items", lambda i: F.struct(i["leaf"].alias("leaf"))).alias("items"))


def paths_down(rounds: list[DataFrame], above: DataFrame, tree: list[str], block: int, arity: int, told: list[str]) -> DataFrame:
    """Leaf blocks with the siblings `above` each block's own node. above: a row a tree with its root's siblings `path` and the columns `told`."""
    keys = ", ".join(f"`{c}` {rounds[0].schema[c].dataType.simpleString()}" for c in tree)
    more = ", ".join(f"`{c}` {above.schema[c].dataType.simpleString()}" for c in told)
    head = ", ".join(x for x in (keys, more) if x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                size, number, items, path = (row.column(c)[0].as_py() for c in ("size", "block", "items", "path"))
                built = _built([x["leaf"] for x in items], _levels(size, block, arity), arity)
                found = [[{"before": a, "after": b} for a, b in built.siblings(j)] + path for j in range(len(items))]
                same = [pa.concat_arrays([row.column(c)] * len(items)) for c in (*tree, *told)]
                kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(len(items)) + number * block), pa.array(found, kind)], [*tree, *told, "block", "path"])

    # a tree of one block ends in the first round; one that goes on has its root in the last of its rounds
    paths = None
    for level in reversed(rounds[1:]):
        ending = _joined(level.where(F.col("size") <= block), above, tree)
        going = None if paths is None else _joined(level.where(F.col("size") > block), paths, [*tree, "block"])
        both = ending if going is None else ending.unionByName(going.select(ending.columns))
        paths = stored(both.mapInArrow(run, f"{head}, block long, path {PATH}"), "paths")
    ending = _joined(rounds[0].where(F.col("size") <= block), above, tree)
    if paths is None:
        return ending
    return ending.unionByName(_joined(rounds[0].where(F.col("size") > block), paths, [*tree, "block"]).select(ending.columns))


def manifest(docs: DataFrame, arity: int = ARITY, most: int = BLOCK, proofs: bool = True) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row; with `proofs` the siblings themselves, `path`."""
    block = arity
    while block * arity <= most:
        block *= arity
    leaves = stored(leaves_of(docs).withColumn("_row", F.monotonically_increasing_id()), "leaves")
    chunks = packed(leaves, ["lang"], ["doc_id", "leaf"], ["doc_id", "leaf", "tampered"], block)
    rounds, subroots = rounds_of(blocks_of(chunks, ["lang"], block), ["lang"], block, arity)
    subroots = stored(subroots.select("lang", "leaf", F.lit(0).alias("all"), F.lit(0).cast("long").alias("_row")), "subroots")
    tops, root = rounds_of(blocks_of(packed(subroots, ["all"], ["lang"], ["lang", "leaf"], block), ["all"], block), ["all"], block, arity)
    above = paths_down(tops, root.select("all", F.col("leaf").alias("root"), F.array().cast(PATH).alias("path")), ["all"], block, arity, ["root"])
    above = stored(above.mapInArrow(lambda b: _spread(b, block, arity), f"lang string, subroot string, root string, path {PATH}"), "above")
    down = paths_down(rounds, above, ["lang"], block, arity, ["subroot", "root"])
    told = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean" + f", path {PATH}" * proofs
    return down.select("size", "block", "items", "subroot", "root", "path").mapInArrow(lambda b: _proofs(b, block, arity, proofs), told)


def _spread(batches: Iterator[pa.RecordBatch], block: int, arity: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in _rows(batch):
            built = _built([x["leaf"] for x in r["items"]], _levels(r["size"], block, arity), arity)
            yield pa.RecordBatch.from_pylist(
                [{"lang": x["lang"], "subroot": x["leaf"], "root": r["root"], "path": [{"before": a, "after": b} for a, b in built.siblings(j)] + r["path"]} for j, x in enumerate(r["items"])],
                pa.schema([("lang", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("path", _PATH)]),
            )


_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _proofs(batches: Iterator[pa.RecordBatch], block: int, arity: int, proofs: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    for batch in batches:
        for r in _rows(batch):
            built = _built([x["leaf"] for x in r["items"]], _levels(r["size"], block, arity), arity)
            top = [(p["before"], p["after"]) for p in r["path"]]
            rows, paths = [], []
            for j, x in enumerate(r["items"]):
                path = built.siblings(j) + top
                node = x["tampered"] or x["leaf"]
                for before, after in path:
                    node = digest(before + node + after)
                proof = digest("".join(s for p in path for s in p))
                rows.append((x["doc_id"], x["leaf"], r["subroot"], r["root"], proof, node, node == r["root"]))
                if proofs:
                    paths.append([{"before": a, "after": b} for a, b in path])
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(paths, _PATH)] * proofs], [*names, *["path"] * proofs])


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), proofs=False)


def _leaf_sql(n_chars: str = "n_chars") -> str:
    told = [f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(told)})"


SQL = {
    "op13_merkle_manifest": f"""
WITH RECURSIVE {CRC_SQL.strip()},
leaves AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf_sql()} AS leaf, CASE WHEN {crc_sql("doc_id::VARCHAR")} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf_sql("(n_chars + 1)")} END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i
  FROM documents, crc_table),
nodes AS (
  SELECT lang, 0 AS level, i, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, any_value(level) + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, i // 2),
subroots AS MATERIALIZED (SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS k FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, k AS i, subroot AS node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM tops WHERE n > 1 GROUP BY i // 2),
steps AS MATERIALIZED (
  SELECT doc_id, s.level AS step, s.node, (leaves.i >> s.level) & 1 = 1 AS is_before
  FROM leaves JOIN nodes s ON s.lang IS NOT DISTINCT FROM leaves.lang AND s.n > 1 AND s.i = xor(leaves.i >> s.level, 1)
  UNION ALL
  SELECT doc_id, height + s.level, s.node, (k >> s.level) & 1 = 1
  FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang JOIN tops s ON s.n > 1 AND s.i = xor(k >> s.level, 1)),
folds AS (
  SELECT doc_id, coalesce(tampered, leaf) AS node, 0 AS step, height + (SELECT max(level) FROM tops) AS steps FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang
  UNION ALL
  SELECT f.doc_id, sha256(CASE WHEN is_before THEN s.node || f.node ELSE f.node || coalesce(s.node, '') END), f.step + 1, f.steps
  FROM folds f LEFT JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step WHERE f.step < f.steps),
proofs AS (SELECT doc_id, string_agg(node, '' ORDER BY step) AS siblings FROM steps GROUP BY doc_id)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folds.node AS folded_root, folds.node = root AS verified
FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang JOIN (SELECT node AS root FROM tops WHERE n = 1) ON true
LEFT JOIN proofs USING (doc_id) JOIN folds USING (doc_id) WHERE folds.step = folds.steps"""
}
QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
