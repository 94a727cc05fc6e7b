"""Embedding near-dedup (operator 9): product quantisation over coarse inverted lists, exact cosine rerank.

Unit vectors are dealt to the cell of their nearest coarse centroid; what is left of each after its centroid is coded in
SUBSPACES parts. A vector's links are sought in its own cell and in the cells that a partner within the radius
r = sqrt(2 - 2 * cosine) may lie in: those whose bisector with the own cell is not further than r. No partner lies beyond,
whatever the spread of the vectors, so every pair is found. Of two cells, the vector in the higher one visits the lower,
so no pair is met twice. In a cell, a lookup table for each visitor gives its distance to every coded member; members
further than r plus their own coding error cannot be partners (triangle inequality), the rest have their exact cosine
taken in double precision. A visitor is sent once to a group of up to GROUP_CELLS cells.

Centroids and codes are fitted on about SAMPLE rows, those of the lowest hash; every row is indexed. Groups of cells are split into
blocks of BLOCK members a cell and VISITORS visitors, so copies that fill a cell spread over tasks; a task sends back counts
and a spanning forest, never all pairs. Rows go by a key of their own, not by vec_id, and vectors keep the element type
that they came in until a task takes their unit vectors in double precision, after a division by their largest component,
so that no length over- or underflows.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing and are kept;
vectors of different lengths are not compared; rows of equal vec_id are each a vector, linked like any others, and all
of a component that have its smallest vec_id are kept; a row without a vec_id gives no component its name, and is kept
where its whole component has none; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import drawn, stored, table
from ._components import components, named, roots

COSINE = 0.9
SAMPLE, MOST_CELLS, CELL_ROWS, SUBSPACES, CODES, TURNS = 16_384, 4096, 512, 8, 256, 6
BLOCK, VISITORS = 1024, 4096
#: Lengths of vectors that one job takes.
DIMS_A_JOB = 16
#: Cells that are sent to a task together, and the groups there should be before cells are joined.
GROUP_CELLS, LEAST_GROUPS = 8, 32
#: For rounding.
SLACK = 1e-9


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def k_means(x: np.ndarray, k: int, turns: int = TURNS) -> np.ndarray:
    """Centroids; starts from rows spread over the sample."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(turns):
        near = np.concatenate([nearest(x[i : i + 1024], c) for i in range(0, len(x), 1024)])
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)


class Quantiser:
    def __init__(self, sample: np.ndarray, cells: int):
        self.dim = sample.shape[1]
        self.width = -(-self.dim // SUBSPACES)
        self.cells = k_means(sample, cells)
        rest = self.padded(sample - self.cells[nearest(sample, self.cells)])
        self.books = [k_means(rest[:, m], CODES) for m in range(rest.shape[1])]

    def padded(self, x: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(x), self.width * -(-self.dim // self.width)))
        wide[:, : self.dim] = x
        return wide.reshape(len(x), -1, self.width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and codes."""
        cell = nearest(x, self.cells)
        rest = self.padded(x - self.cells[cell])
        return cell, np.stack([nearest(rest[:, m], b) for m, b in enumerate(self.books)], 1).astype(np.uint8)

    def decode(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        parts = [b[codes[:, m]] for m, b in enumerate(self.books)]
        return np.concatenate(parts, 1)[:, : self.dim] + self.cells[cell]

    def probes(self, x: np.ndarray, cell: np.ndarray, radius: float) -> list[np.ndarray]:
        """Lower cells that each row visits."""
        size = (self.cells**2).sum(1)
        d = size[None] - 2 * x @ self.cells.T
        own, at = np.unique(cell, return_inverse=True)  # the cells' distances for these rows alone: a square matrix would grow with the cells
        apart = np.sqrt(np.maximum(size[own][:, None] + size[None] - 2 * self.cells[own] @ self.cells.T, 1e-24))
        border = (d - d[np.arange(len(x)), cell][:, None]) / (2 * apart[at])
        lower = np.arange(len(self.cells))[None] < cell[:, None]
        near = lower & (border <= radius + SLACK)
        return [np.flatnonzero(row) for row in near]


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1).astype(np.float64)


def links_of(q: Quantiser, cell: int, visitors: np.ndarray, members: np.ndarray, codes: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (visitor, member) of pairs with at least the cosine."""
    radius = math.sqrt(2 - 2 * cosine)
    guess = q.decode(np.full(len(members), cell), codes)
    error = np.linalg.norm(members - guess, axis=1)
    # a member is no partner where 1 + |guess|^2 - 2 * dot is over (radius + error)^2
    least = ((1 + (guess**2).sum(1) - (radius + error) ** 2) / 2 - 1e-5).astype(np.float32)[:, None]
    by_part = np.ascontiguousarray(codes.T.astype(np.intp))
    found = []
    for i in range(0, len(visitors), 256):
        v = visitors[i : i + 256]
        parts = q.padded(v)
        dot = np.repeat((q.cells[cell] @ v.T).astype(np.float32)[None], len(members), 0)
        row = np.empty_like(dot)
        for m, book in enumerate(q.books):  # a table of all codes for each visitor; a member takes the row of its code
            dot += np.take((book @ parts[:, m].T).astype(np.float32), by_part[m], axis=0, out=row, mode="clip")
        b, a = np.nonzero(dot >= least)
        for k in range(0, len(a), 1 << 18):
            s, t = a[k : k + (1 << 18)], b[k : k + (1 << 18)]
            good = np.einsum("ij,ij->i", v[s], members[t]) >= cosine
            found.append((s[good] + i, t[good]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _linked(rows: DataFrame, dim: int, n: int, cosine: float) -> DataFrame:
    """(id, links, root) parts: how many links of an id a task found, and the id its forest hangs it on."""
    radius = math.sqrt(2 - 2 * cosine)
    kind = dict(rows.dtypes)["v"]
    sample = drawn(rows, "id", n, SAMPLE, 17).select("id", "v").toArrow().sort_by("id")
    q = Quantiser(unit(_matrix(sample.column("v"))), max(1, min(MOST_CELLS, n // CELL_ROWS, sample.num_rows // 4)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                x = unit(_matrix(part.column("v")))
                cell, codes = q.encode(x)
                probes = q.probes(x, cell, radius)
                at = np.cumsum([0, *map(len, probes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*probes, []]).astype(np.int32)))], ["id", "v", "cell", "codes", "probes"])

    dealt = stored(rows.select("id", "v").mapInArrow(deal, f"id long, v {kind}, cell int, codes binary, probes array<int>"), "dealt")
    joined = max(1, min(GROUP_CELLS, len(q.cells) // LEAST_GROUPS))
    of_group = lambda c: F.floor(c / joined).cast("int")
    dealt = dealt.withColumn("group", of_group(F.col("cell")))
    away = dealt.select("id", "v", "probes", F.explode(F.array_distinct(F.transform("probes", of_group))).alias("group"))
    visits = away.groupBy("group").agg(F.count("*").alias("foreign"))
    sizes = dealt.groupBy("group").agg(F.count("*").alias("own")).join(visits, "group", "left")
    sizes = sizes.select("group", F.ceil(F.col("own") / (BLOCK * joined)).cast("int").alias("blocks"), F.ceil((F.col("own") + F.coalesce("foreign", F.lit(0))) / VISITORS).cast("int").alias("chunks"))
    sizes = F.broadcast(sizes)  # at most MOST_CELLS rows
    pick = lambda salt, of: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(of)).cast("int")
    upto = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    member = dealt.join(sizes, "group").select("id", "v", "codes", F.array("cell").alias("cells"), "group", pick(1, "blocks").alias("block"), F.explode(upto("chunks")).alias("chunk"), F.lit(True).alias("member"), F.lit(-1).alias("home_block"))
    own = dealt.join(sizes, "group").select("id", "v", F.array("cell").alias("cells"), "group", pick(1, "blocks").alias("home_block"), pick(2, "chunks").alias("chunk"), F.explode(upto("blocks")).alias("block")).where("block <= home_block")
    foreign = away.withColumn("cells", F.filter("probes", lambda c: of_group(c) == F.col("group")))
    foreign = foreign.join(sizes, "group").select("id", "v", "cells", "group", F.lit(1 << 30).alias("home_block"), pick(2, "chunks").alias("chunk"), F.explode(upto("blocks")).alias("block"))
    names = ["id", "v", "codes", "cells", "group", "block", "chunk", "member", "home_block"]
    visitor = own.unionByName(foreign).withColumns({"codes": F.lit(None).cast("binary"), "member": F.lit(False)})

    def match(group: pa.Table) -> pa.Table:
        mine = group.filter(group.column("member"))
        theirs = group.filter(pc.invert(group.column("member")))
        if not mine.num_rows or not theirs.num_rows:
            return EMPTY.empty_table()
        m_id, v_id = mine.column("id").to_numpy(), theirs.column("id").to_numpy()
        codes = np.frombuffer(b"".join(mine.column("codes").to_pylist()), np.uint8).reshape(len(m_id), -1)
        m_cell, visited = (pc.list_flatten(t.column("cells")).to_numpy() for t in (mine, theirs))
        visitor = pc.list_parent_indices(theirs.column("cells")).to_numpy()
        m, v = unit(_matrix(mine.column("v"))), unit(_matrix(theirs.column("v")))
        at_home = theirs.column("home_block").to_numpy() == mine.column("block")[0].as_py()
        ids, at = np.unique(np.concatenate([v_id, m_id]), return_inverse=True)
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for cell in np.unique(m_cell).tolist():
            here, all_there = np.flatnonzero(m_cell == cell), visitor[visited == cell]
            for i in range(0, len(all_there), 256):  # what a hot cell finds is counted before it piles up
                there = all_there[i : i + 256]
                a, b = links_of(q, cell, v[there], m[here], codes[here], cosine)
                a, b = there[a], here[b]
                keep = ~at_home[a] | (v_id[a] > m_id[b])  # within a block both are members: one order of each pair
                a, b = at[a[keep]], at[len(v_id) + b[keep]]
                if len(a):
                    links += np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
                    root = roots(len(ids), root[a], root[b])[root]
        some = links > 0
        return pa.table({"id": ids[some], "links": links[some], "root": ids[root[some]]}, schema=EMPTY)

    EMPTY = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    return member.select(names).unionByName(visitor.select(names)).groupBy("group", "block", "chunk").applyInArrow(match, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    vectors = vectors.select(F.monotonically_increasing_id().alias("id"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    vectors = stored(vectors, "vectors")
    good = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.where(good).withColumn("dim", F.size("v"))
    dims = rows.groupBy("dim").count().orderBy("dim").collect()
    parts = []
    for i in range(0, len(dims), DIMS_A_JOB):
        some = [_linked(rows.where(F.col("dim") == r.dim), r.dim, r["count"], cosine) for r in dims[i : i + DIMS_A_JOB]]
        parts.append(stored(reduce(DataFrame.unionByName, some), "links"))
    ids = vectors.select("id", "vec_id")
    if not parts:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = reduce(DataFrame.unionByName, parts)
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    classes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = stored(classes.join(ids.withColumnRenamed("vec_id", "name"), "id"), "classes")
    of = named(classes, classes.count()).select("id", "least", F.lit(True).alias("linked"))
    out = ids.join(links, "id", "left").join(of, "id", "left")
    component = F.when(F.col("linked"), F.col("least")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def op9_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op9_pq_near_dedup": op9_pq_near_dedup}
SQL: dict[str, str] = {}
