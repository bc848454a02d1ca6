"""MinHash near-duplicate classes with circulant signatures and exact confirmation.

A document's set holds the distinct hashes of its five-word shingles. The signature is C-MinHash
(Li and Li, 2022): one permutation sigma is applied to every shingle once, and coordinate k is the
minimum of a second permutation pi, shifted circularly by k steps, over the set. Both are bijections
on 32 bits, so no table is kept. Bands of the signature give buckets; links are confirmed on full sets.

Work on a bucket does not grow with the square of its size in emitted rows:

1. documents with equal sets form one class, which is one node; its doc is their smallest doc_id;
2. every node of a bucket is compared with the bucket's smallest node (its center): one distinct pair
   for each (center, node), whatever number of bands they share;
3. buckets in which some node is not linked to the center are finished exactly: blocks of nodes are
   compared inside a task by a matrix product of their sets, and only a spanning forest of the links
   is emitted. Nodes that are already known to be linked to the center are not compared again.

So every pair that shares a bucket is linked, connected already, or compared on its full sets.
With 24 bands of 5 coordinates, a pair with similarity 0.85 shares no bucket with probability 8e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import words as W
from shelfrank.llm.components import components
from shelfrank.llm.tables import Scratch, filter_slot, groups, key_filter, passes, per_batch

SHINGLE = 5
BANDS = 24
ROWS = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
#: A block of step 3 holds about so many nodes and bytes of sets at most (a larger single set is one block).
BLOCK_NODES = 512
BLOCK_BYTES = 4 << 20
#: Members that are compared with one copy of their center's set.
CENTER_SHARE = 256

_SHIFT = 0x01000193
_COLUMNS = 4096


def sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text, and row bounds. Null and wordless texts
    have empty sets."""
    values, bounds = [], [np.zeros(1, np.int64)]
    for a, b in W.slices(column):
        w = W.words(column.slice(a, b - a))
        v, rows = W.distinct(*W.shingles(w.hashes, w.rows, size))
        bounds.append(rows[1:] + bounds[-1][-1])
        values.append(v)
    return np.concatenate(values) if values else np.zeros(0, np.uint64), np.concatenate(bounds)


def _pi(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on 32 bits that mixes well (xor-shifts and odd multipliers), in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(values: np.ndarray, rows: np.ndarray, coords: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash signatures, one row for each set; empty sets get zeros."""
    out = np.zeros((len(rows) - 1, coords), np.uint32)
    full = np.flatnonzero(rows[:-1] < rows[1:])
    at = 0
    while at < len(full):  # blocks that stay in the CPU's cache
        end = at + 1
        while end < len(full) and rows[full[end] + 1] - rows[full[at]] <= 65536:
            end += 1
        lo, hi = rows[full[at]], rows[full[end - 1] + 1]
        sigma = (values[lo:hi] * W.GOLDEN >> np.uint64(32)).astype(np.uint32)
        heads = rows[full[at:end]] - lo
        for k in range(coords):
            shifted = sigma - np.uint32(k * _SHIFT & 0xFFFFFFFF)
            out[full[at:end], k] = np.minimum.reduceat(_pi(shifted), heads)
        at = end
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key for each band; the band's number is part of it."""
    out = np.zeros((len(signature), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(signature), b + 1, np.uint64)
        for c in range(b * rows, (b + 1) * rows):
            h = W.mix(h * W.GOLDEN + signature[:, c])
        out[:, b] = h
    return out


def _sketch(size: int, bands: int, rows: int):
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = batch.column(0), batch.column(1)
        values, bounds = sets(texts, size)
        keys = band_keys(signatures(values, bounds, bands * rows), bands, rows).view(np.int64)
        n = np.diff(bounds)
        digests = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
                   for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
        return pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(digests, pa.binary()), lists],
                                          names=["doc_id", "n_shingles", "set_key", "buckets"])
    return per_batch(one)


def _set_bytes(size: int, wanted):
    """The sets of the rows whose slot passes the broadcast key filter."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = batch.filter(pa.array(passes(wanted.value, batch.column("slot").to_numpy())))
        values, bounds = sets(batch.column("text"), size)
        blobs = [values[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        digests = [hashlib.blake2b(blob, digest_size=16).digest() for blob in blobs]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(blobs, pa.binary())],
                                          names=["doc", "set_key", "shingles"])
    return per_batch(one)


def _array(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64)


def linked(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | bool:
    return 100 * common >= percent * (a + b - common)


def _with_center(percent: int):
    """Rows sorted by (center, share, is_member): the center's set comes first, then members stream by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (center, _), parts in groups(batches, ["center", "share"]):
            mine = own = None
            for part in parts:
                nodes, docs, found = [], [], []
                for node, doc, blob in zip(part.column("node").to_pylist(), part.column("doc").to_pylist(), part.column("shingles")):
                    other = _array(blob)
                    if mine is None:
                        mine, own = other, doc
                        continue
                    at = np.searchsorted(mine, other)
                    at[at == len(mine)] = 0
                    common = int(np.count_nonzero(mine[at] == other))
                    nodes.append(node)
                    docs.append(doc)
                    found.append(bool(linked(common, len(mine), len(other), percent)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([center] * len(nodes), pa.int64()), pa.array(nodes, pa.int64()), pa.array(found, pa.bool_()),
                     pa.array([own] * len(nodes), pa.int64()), pa.array(docs, pa.int64())],
                    names=["center", "node", "linked", "a", "b"])
    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted distinct arrays, as a matrix."""
    values = np.concatenate(left + right)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    uniq, index, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[index]
    rows, cols = rows[keep], column[index[keep]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(cols, [start, start + _COLUMNS])
        m = np.zeros((len(left) + len(right), min(_COLUMNS, int(shared.sum()) - start)), np.float32)
        m[rows[a:b], cols[a:b] - start] = 1
        out += np.rint(m[:len(left)] @ m[len(left):].T).astype(np.int64)
    return out


def forest(nodes_a: list[int], nodes_b: list[int], known: set[int], hits: np.ndarray) -> list[tuple[int, int]]:
    """The linked pairs (rows of ``hits``) that join what is not joined yet; ``known`` nodes are."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if known:
        first = min(known)
        for x in known:
            parent[find(x)] = find(first)
    out = []
    for i, j in hits.tolist():
        a, b = find(nodes_a[i]), find(nodes_b[j])
        if a != b:
            parent[a] = b
            out.append((nodes_a[i], nodes_b[j]))
    return out


def _block_links(percent: int):
    """One group (bucket, i, j) is a pair of blocks of a bucket: i = j compares a block with itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), parts in groups(batches, ["bucket", "i", "j"]):
            side: dict[int, list[tuple[int, bool, np.ndarray]]] = {i: [], j: []}
            docs: dict[int, int] = {}
            for part in parts:
                docs.update(zip(part.column("node").to_pylist(), part.column("doc").to_pylist()))
                for block, node, seed, blob in zip(part.column("block").to_pylist(), part.column("node").to_pylist(),
                                                   part.column("seed").to_pylist(), part.column("shingles")):
                    side[block].append((node, seed, _array(blob).copy()))
            left, right = side[i], side[j]
            if not left or not right:
                continue
            common = common_counts([x[2] for x in left], [x[2] for x in right])
            la, lb = np.array([len(x[2]) for x in left]), np.array([len(x[2]) for x in right])
            good = linked(common, la[:, None], lb[None, :], percent)
            if i == j:
                good &= np.tri(len(left), k=-1, dtype=bool)
            known = {x[0] for x in left + right if x[1]}
            edges = forest([x[0] for x in left], [x[0] for x in right], known, np.argwhere(good))
            yield pa.RecordBatch.from_arrays(
                [pa.array([docs[e[0]] for e in edges], pa.int64()), pa.array([docs[e[1]] for e in edges], pa.int64())], names=["a", "b"])
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, bands: int = BANDS, rows: int = ROWS,
                    percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    Words are runs without white space, A-Z lower-cased. component_id is the smallest doc_id reachable
    over links, the document's own included; kept tells whether it is its own. Null and wordless texts
    have no shingles and no links. Rows that share a doc_id count as one document. A row without
    doc_id is in no component (component_id null) and kept. Other columns are ignored.
    """
    scratch = Scratch(spark, "near-dup")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = scratch.table(base.mapInArrow(
        _sketch(size, bands, rows), "doc_id long, n_shingles long, set_key binary, buckets array<long>"), "sketch")

    known = sketch.where("doc_id is not null and set_key is not null")
    # Classes may share their smallest doc_id, so the node is a number of the stored class.
    classes = scratch.table(known.groupBy("set_key").agg(F.min("doc_id").alias("doc")).withColumn(
        "node", F.monotonically_increasing_id()), "classes")
    reps = known.join(classes, "set_key").where("doc_id = doc").select("node", "n_shingles", "buckets").dropDuplicates(["node"])
    buckets = reps.select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    # Aggregates that are joined back are stored first: Spark splits a hot key of a join only between plain inputs.
    heads = scratch.table(buckets.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1"), "heads")
    hits = scratch.table(buckets.join(heads, "bucket"), "hits")

    pairs = scratch.table(hits.where("node <> center").select("center", "node").distinct(), "pairs")
    wanted = scratch.table(pairs.select("node").union(pairs.select(F.col("center").alias("node"))).distinct().join(
        classes, "node").select("node", "doc", "set_key"), "wanted")
    # The filter keeps the texts of other documents out of the shuffle; the join drops what it lets by.
    bits = spark.sparkContext.broadcast(key_filter(wanted, "doc"))
    some = base.where("doc_id is not null").withColumn("slot", filter_slot(F.col("doc_id"))).mapInArrow(
        _set_bytes(size, bits), "doc long, set_key binary, shingles binary")
    shingle_sets = scratch.table(some.join(wanted, ["doc", "set_key"]).where("length(shingles) > 0").select(
        "node", "doc", "shingles").distinct(), "sets")

    shares = pairs.groupBy("center").agg(F.ceil(F.count("*") / F.lit(CENTER_SHARE)).cast("int").alias("shares"))
    members = pairs.join(shares, "center").select(
        "center", F.pmod(F.xxhash64("node"), "shares").cast("int").alias("share"), "node").join(shingle_sets, "node")
    centers = shares.join(shingle_sets, shares.center == shingle_sets.node).select(
        "center", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "node", "doc", "shingles")
    checked = scratch.table(
        members.select("center", "share", "node", "doc", "shingles").withColumn("member", F.lit(1))
        .union(centers.withColumn("member", F.lit(0)))
        .repartition("center", "share").sortWithinPartitions("center", "share", "member")
        .select("center", "share", "node", "doc", "shingles")
        .mapInArrow(_with_center(percent), "center long, node long, linked boolean, a long, b long"), "checked")

    seeded = scratch.table(hits.join(checked.select("center", "node", "linked"), ["center", "node"], "left").where("n > 2").select(
        "bucket", "node", "n_shingles", F.coalesce("linked", F.lit(True)).alias("seed")), "seeded")  # a center itself has no pair
    size_of = F.ceil(F.sum(F.col("n_shingles") * 8) / F.lit(BLOCK_BYTES))
    blocks = scratch.table(seeded.groupBy("bucket").agg(
        F.count_if(~F.col("seed")).alias("loose"),
        F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_NODES)), size_of).cast("int").alias("g")).where("loose > 0").select("bucket", "g"), "blocks")
    placed = seeded.join(blocks, "bucket").select(
        "bucket", "node", "seed", "g", F.pmod(F.xxhash64("node", "bucket"), "g").cast("int").alias("block"))
    units = placed.select("bucket", "node", "seed", "block", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other")).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "seed")
    late = units.join(shingle_sets, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").select(
        "bucket", "i", "j", "block", "node", "seed", "doc", "shingles").mapInArrow(_block_links(percent), "a long, b long")

    # Rows that share a doc_id but not their text are one document: their classes are linked.
    owned = known.join(classes, "set_key").select("doc_id", "doc").distinct()
    split_ids = owned.groupBy("doc_id").agg(F.min("doc").alias("a"), F.max("doc").alias("z")).where("a <> z")
    same_id = owned.join(split_ids, "doc_id").select("a", F.col("doc").alias("b")).where("a <> b")
    edges = scratch.table(checked.where("linked").select("a", "b").union(late).union(same_id).where("a <> b").distinct(), "links")
    parts = components(scratch, edges).withColumnRenamed("node", "doc")
    ids = scratch.table(classes.join(parts, "doc", "left").select(
        "set_key", F.coalesce("component", "doc").alias("component")), "class-components")
    scratch.drop("classes", "heads", "hits", "pairs", "wanted", "sets", "checked", "seeded", "blocks", "links")
    rows = sketch.join(ids, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
