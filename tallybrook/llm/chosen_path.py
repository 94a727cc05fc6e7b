"""N-gram Jaccard join (operator 5): chosen-path join on five-word shingles, similarity 0.8.

Words are runs between ASCII white space, in lower case. A text's set of shingles is embedded in TOKENS min-hash tokens.
A run is a tree: at each node every token is drawn with chance 1 / (SPLIT * TOKENS), by a hash of the node and the token
alone, and the text goes on into one child for each token drawn; so texts that share many tokens keep meeting, and each
text finds its own nodes without seeing another. The nodes at `depth` are the buckets. A pair of the threshold's
similarity meets in a run with the chance that the critical branching process lives so long; runs repeat until the
chance of never meeting is at most 1 - recall.

Small buckets are compared by brute force on one-bit min-hash sketches, at a bar five standard deviations under the
threshold. In larger buckets each text is first compared with the smallest; those unlike it are compared with all of the
bucket, in pairs of blocks, of which a task gives a spanning forest. The components of these ties are then compared
whole, by exact Jaccard of the shingle sets: small ones many to a task, large ones in pairs of blocks of at most BLOCK
texts, or of BLOCK_SHINGLES where texts are long; so no task holds more than two blocks and no list of all pairs leaves
a task. Buckets, classes and components that hold many rows are joined without moving those.

Texts of equal shingle sets are one class of copies: one stands for all, and counts say how many there are.

Cases: null texts and texts without a word link with nothing; a text of under five words has one shingle of all of them;
rows of equal doc_id are each judged by their own text, and count as copies where their texts are equal; rows without a
doc_id are compared like any, and give a class its name (null) only where no row of it has one; an empty table gives no
rows; other columns play no part, and `one_of_each` keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._base import bytes_of, join_counted, mix, pieces, shingles_of, stored, table, words_of
from ._components import components, named, roots

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.999
TOKENS, SPLIT, DEPTH = 128, 0.8, 4
SMALL_BUCKET, BLOCK, GROUP_ROWS = 32, 512, 2000
#: Hashes that a group of whole components holds about (32 MB), and a block of a larger one at most.
SKETCH_BLOCK, BLOCK_SHINGLES, GROUP_SHINGLES = 2048, 1 << 20, 1 << 22
#: Bits of 128 in which sketches may differ: at the threshold 12.8 do on average, with a deviation of 3.4.
SKETCH_BITS = 30
#: A character that belongs to a word.
WORD = r"[^\x09-\x0d\x1c-\x20]"
SEEDS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def meeting(depth: int, similarity: float, split: float) -> float:
    """Chance that a pair still shares a node after `depth` levels."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-similarity / split * p)
    return p


def runs_for(recall: float, depth: int, similarity: float = SIMILARITY, split: float = SPLIT) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - meeting(depth, similarity, split)))


def depth_for(n: int) -> int:
    """A level more for each 32-fold of texts beyond 32 ** DEPTH."""
    return max(DEPTH, math.ceil(math.log(max(n, 2), 32)))


def sets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, off = bytes_of(pc.utf8_lower(pc.fill_null(texts, "")))
    words, _, counts = words_of(raw, off)
    return shingles_of(words, counts, WORDS)


def prints_of(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set."""
    out = []
    for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)):
        sums = np.append(np.cumsum(mix(hashes ^ salt), dtype=np.uint64), np.uint64(0))
        first = np.where(at[:-1] > 0, sums[at[:-1] - 1], np.uint64(0))
        last = np.where(at[1:] > 0, sums[at[1:] - 1], np.uint64(0))
        out.append(mix(last - first + np.diff(at).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def min_hashes(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, TOKENS) 32-bit min-hashes; texts without a shingle get zeros."""
    some = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, TOKENS), np.uint32)
    if len(some):
        for t, seed in enumerate(SEEDS):
            out[some, t] = np.minimum.reduceat(((hashes * seed) >> np.uint64(32)).astype(np.uint32), at[:-1][some])
    return out


def sketches(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = (tokens * np.uint32(0x9E3779B1)) >> np.uint32(31)
    packed = np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)
    return packed[:, 0], packed[:, 1]


def buckets_of(tokens: np.ndarray, runs: int, depth: int, split: float = SPLIT) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the nodes that each text reaches."""
    bar = np.uint32(int(2**32 / (split * TOKENS)))
    salted = tokens * np.uint32(0x85EBCA77) + np.arange(TOKENS, dtype=np.uint32) * np.uint32(0xC2B2AE3D)
    texts, nodes = [], []
    for run in range(runs):
        text = np.arange(len(tokens))
        node = np.full(len(tokens), mix(np.array([run + 1], np.uint64))[0])
        for _ in range(depth):
            next_text, next_node = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for i in range(0, len(text), 8192):
                t, p = text[i : i + 8192], node[i : i + 8192]
                h = salted[t] ^ (p >> np.uint64(32)).astype(np.uint32)[:, None]
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                h ^= h >> np.uint32(12)
                h *= np.uint32(0x297A2D39)
                h ^= h >> np.uint32(15)
                a, b = np.nonzero(h < bar)
                next_text.append(t[a])
                next_node.append(mix(p[a] ^ mix((tokens[t[a], b].astype(np.uint64) << np.uint64(8)) + b.astype(np.uint64))))
            text, node = np.concatenate(next_text), np.concatenate(next_node)
        texts.append(text)
        nodes.append(node)
    return np.concatenate(texts), np.concatenate(nodes).view(np.int64)


def printed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), "text")


def described(docs: DataFrame, runs: int, depth: int) -> DataFrame:
    """key (a number of the row), doc_id, print (of the text), fp1, fp2, n shingles, sketch and buckets of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                hashes, at = sets_of(piece.column("text"))
                fp1, fp2 = prints_of(hashes, at)
                tokens = min_hashes(hashes, at)
                s1, s2 = sketches(tokens)
                n = np.diff(at)
                some = np.flatnonzero(n)
                text, bucket = buckets_of(tokens[some], runs, depth)
                order = np.argsort(some[text], kind="stable")
                ends = np.cumsum(np.bincount(some[text], minlength=len(n)))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(bucket[order]))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("print"), pa.array(fp1), pa.array(fp2), pa.array(n), pa.array(s1), pa.array(s2), lists], ["doc_id", "print", "fp1", "fp2", "n", "s1", "s2", "buckets"])

    out = printed(docs).mapInArrow(run, "doc_id long, print long, fp1 long, fp2 long, n long, s1 long, s2 long, buckets array<long>")
    return out.withColumn("key", F.monotonically_increasing_id())


def differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}1").bitwiseXOR(F.col(f"{b}1"))) + F.bit_count(F.col(f"{a}2").bitwiseXOR(F.col(f"{b}2")))


def ties(rows: DataFrame, total: int) -> DataFrame:
    """Edges (a, b) between texts that meet in a bucket and may be alike; `rows` have `total` buckets."""
    dealt = rows.select("id", F.explode("buckets").alias("bucket"))
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("hub")).where("size > 1")
    dealt = stored(join_counted(dealt, sizes, "bucket", "size", total), "shared")  # few buckets have two texts
    sketch = rows.select("id", "n", "s1", "s2")
    small = dealt.where(F.col("size") <= SMALL_BUCKET).select("bucket", "id").join(sketch, "id")
    x, y = small.alias("x"), small.alias("y")
    near = (F.col("x.id") > F.col("y.id")) & (differ("x.s", "y.s") <= SKETCH_BITS) & (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * SIMILARITY)
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    large = dealt.where(F.col("size") > SMALL_BUCKET)
    if not large.take(1):
        return pairs.distinct()
    hubs = large.where("id = hub").select("bucket", "hub", "size").join(sketch.select(F.col("id").alias("hub"), F.col("s1").alias("h1"), F.col("s2").alias("h2")), "hub")
    large = join_counted(large.drop("hub", "size").join(sketch, "id"), hubs, "bucket", "size", total).withColumn("tied", differ("s", "h") <= SKETCH_BITS)
    large = stored(large.select("bucket", "id", "n", "s1", "s2", "hub", "size", "tied"), "large")
    tied = large.where(F.col("tied") & (F.col("id") != F.col("hub"))).select(F.col("id").alias("a"), F.col("hub").alias("b"))
    return pairs.union(tied).union(unlike_hub(large, total)).distinct()


def unlike_hub(large: DataFrame, total: int) -> DataFrame:
    """Edges between the texts of large buckets that are unlike their hub, and those that they may be alike to."""
    blocks = lambda n: F.ceil(F.col(n) / SKETCH_BLOCK).cast("int")
    loose = large.groupBy("bucket").agg(F.count_if(~F.col("tied")).alias("loose"), F.count("*").alias("of")).where("loose > 0")
    loose = loose.select("bucket", "of", blocks("loose").alias("ours"), blocks("of").alias("theirs"))
    rows = join_counted(large.drop("hub", "size"), loose, "bucket", "of", total)
    pick = lambda salt, of: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(of)).cast("int")
    upto = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    kept = ["bucket", "id", "n", "s1", "s2", "i", "j", "own"]
    ours = rows.where(~F.col("tied")).withColumns({"i": pick(5, "ours"), "own": F.lit(True)}).withColumn("j", upto("theirs")).select(kept)
    theirs = rows.withColumns({"j": pick(6, "theirs"), "own": F.lit(False)}).withColumn("i", upto("ours")).select(kept)

    def compare(group: pa.Table) -> pa.Table:
        ids, n, s1, s2, own = (group.column(c).to_numpy() for c in ("id", "n", "s1", "s2", "own"))
        s1, s2 = s1.view(np.uint64), s2.view(np.uint64)  # bits of signed numbers are counted without the sign
        ids, at = np.unique(ids, return_inverse=True)
        left, right, root = np.flatnonzero(own), np.flatnonzero(~own), np.arange(len(ids))
        for k in range(0, len(left), 128):  # what many like texts give is joined before it piles up
            a = left[k : k + 128]
            bits = np.bitwise_count(s1[a][:, None] ^ s1[right][None]) + np.bitwise_count(s2[a][:, None] ^ s2[right][None])
            x, y = np.nonzero((bits <= SKETCH_BITS) & (np.minimum(n[a][:, None], n[right][None]) >= SIMILARITY * np.maximum(n[a][:, None], n[right][None])))
            root = roots(len(ids), root[at[a[x]]], root[at[right[y]]])[root]
        some = root != np.arange(len(ids))
        return pa.table({"a": ids[some], "b": ids[root[some]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return ours.union(theirs).groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")


def alike(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (left, right) of pairs of sets with at least the similarity."""
    both = np.union1d(left, right)
    flat, size = np.concatenate([sets[i] for i in both]), np.array([len(sets[i]) for i in both])
    _, code, often = np.unique(flat, return_inverse=True, return_counts=True)
    shared = often > 1
    column = np.cumsum(shared) - 1
    row, keep = np.repeat(np.arange(len(both)), size), shared[code]
    row, col = row[keep], column[code[keep]]
    li, ri = np.searchsorted(both, left), np.searchsorted(both, right)
    common = np.zeros((len(left), len(right)), np.float32)
    for c in range(0, int(shared.sum()), 8192):
        inside = (col >= c) & (col < c + 8192)
        m = np.zeros((len(both), min(8192, int(shared.sum()) - c)), np.float32)
        m[row[inside], col[inside] - c] = 1
        common += m[li] @ m[ri].T
    union = size[li][:, None] + size[ri][None] - common
    return np.nonzero((common >= similarity * union - 1e-6) & (common > 0))


def exact(members: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """(id, links, root) parts for members (id, doc_id, print, fp1, fp2, copies, component, size, shingles): exact links within components."""
    rows, shingles = members.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = max(1, -(-rows // GROUP_ROWS), -(-shingles // GROUP_SHINGLES))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.least(F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.col("size"))).cast("int")
    members = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("blocks")).cast("int"))
    m, d = members.hint("merge").alias("m"), printed(docs).alias("d")  # members grow with the input: no broadcast
    texts = d.join(m, F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.print") == F.col("m.print"))).select("d.text", "m.*")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                hashes, at = sets_of(piece.column("text"))
                fp1, fp2 = prints_of(hashes, at)
                own = (fp1 == piece.column("fp1").to_numpy()) & (fp2 == piece.column("fp2").to_numpy())
                held = pa.array([hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                columns = [piece.column(c) for c in ("id", "copies", "component", "blocks", "block")]
                yield pa.RecordBatch.from_arrays([*columns, held], ["id", "copies", "component", "blocks", "block", "set"]).filter(pa.array(own))

    texts = texts.mapInArrow(sets, "id long, copies long, component long, blocks int, block int, set binary").dropDuplicates(["id"])
    one, block = F.col("blocks") == 1, F.col("block")
    texts = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = texts.withColumns({"one": F.when(one, F.pmod(F.xxhash64("component"), F.lit(groups)).cast("long")).otherwise(F.col("component")), "i": F.when(one, -1).otherwise(F.least(block, "other")), "j": F.when(one, -1).otherwise(F.greatest(block, "other"))}).drop("other")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, copies, block, comp = (group.column(c).to_numpy() for c in ("id", "copies", "block", "component"))
        own = [np.frombuffer(s, np.uint64) for s in group.column("set").to_pylist()]
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if i == j:  # one block, or whole components
            order = np.argsort(comp, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
                x, y = alike(own, at, at, similarity)
                a.append(at[x[x < y]])
                b.append(at[y[x < y]])
        else:
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if len(left) and len(right):
                x, y = alike(own, left, right, similarity)
                a.append(left[x])
                b.append(right[y])
        a, b = np.concatenate(a), np.concatenate(b)
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        root = roots(len(ids), a, b)
        some = links > 0
        return pa.table({"id": ids[some], "links": links[some].astype(np.int64), "root": ids[root[some]]}, schema=pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    return dealt.groupBy("one", "i", "j").applyInArrow(compare, "id long, links long, root long")


def classed(docs: DataFrame, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows as described, and classes of equal sets: fp1, fp2, id (the smallest key), copies, name (the smallest doc_id),
    component, least (the smallest name of the component) and n_links."""
    depth = depth_for(docs.count())
    rows = stored(described(docs, runs_for(recall, depth), depth), "described")
    classes = rows.where("n > 0").groupBy("fp1", "fp2").agg(F.min("key").alias("id"), F.min("doc_id").alias("name"), F.count("*").alias("copies"))
    classes = stored(classes, "classes")
    stand = stored(rows.withColumnRenamed("key", "id").join(classes.select("id", "name", "copies").hint("merge"), "id"), "stand")
    n, total = stand.agg(F.count("*"), F.coalesce(F.sum(F.size("buckets")), F.lit(0))).first()
    tied = components(ties(stand, total))
    members = stored(stand.drop("buckets", "s1", "s2").join(tied, "id"), "tied")
    sizes = members.groupBy("component").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    members = stored(join_counted(members, sizes, "component", "size", n), "members")
    found = stored(exact(members, docs, similarity), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = classes.join(links, "id", "left").join(linked, "id", "left")
    classes = classes.withColumns({"component": F.coalesce("component", "id"), "n_links": F.coalesce("links", F.lit(0)) + F.col("copies") - 1}).drop("links")
    return rows, named(stored(classes, "linked"), n)


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (the smallest doc_id reachable by links) and n_links (other rows at least so similar) of every row."""
    rows, classes = classed(docs, similarity, recall)
    out = join_counted(rows.where("n > 0"), classes, ["fp1", "fp2"], "copies", rows.count())
    out = out.select("doc_id", F.col("least").alias("class_id"), F.col("n_links").cast("long").alias("n_links"))
    return out.union(rows.where("n = 0").select("doc_id", "doc_id", F.lit(0).cast("long")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with one of each class: that of the smallest doc_id, once. Rows without a word all stay."""
    rows, classes = classed(docs, SIMILARITY, RECALL)
    first = classes.where(F.col("name").eqNullSafe(F.col("least"))).groupBy("component").agg(F.min("id").alias("id"))
    first = classes.join(first.select("id").hint("merge"), "id", "left_semi").select("fp1", "fp2", "name", "copies")
    kept = join_counted(rows.where("n > 0"), first, ["fp1", "fp2"], "copies", rows.count()).where(F.col("doc_id").eqNullSafe(F.col("name")))
    kept = kept.groupBy("fp1", "fp2").agg(F.min("key").alias("key")).select("key")
    kept = stored(rows.join(kept.hint("merge"), "key").select("doc_id", "print"), "kept")
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    held = docs.where(~wordless).select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_print"))
    of = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_print") == F.col("print"))
    return held.join(kept.hint("merge"), of, "left_semi").dropDuplicates(["_id", "_print"]).select("row.*").unionByName(docs.where(wordless))


def op5_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


QUERIES = {"op5_chosen_path_join": op5_chosen_path_join}
SQL: dict[str, str] = {}
