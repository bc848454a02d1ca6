"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive of score p asks for the best
rows of other labels with ``low * p <= 100 * score <= high * p``. The upper limits of an anchor's positives cut
the scores into disjoint slots; combiners keep the best rows of each slot (in a task while blocks of rows
stream by, then over the tasks), and the answer to a positive is a merge of its own and all lower slots,
read from the top down to its lower limit. So one pass over the rows answers all overlapping windows.

Anchors meet all rows in blocks: a cell is a block of anchors and a stripe of rows. A task holds the
vectors of its block and the few rows kept for each of its anchors; the rows stream through it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm.tables import Scratch, groups

#: Anchors of a block: 16,384 vectors of 64 components take 8 MB.
ANCHOR_BLOCK = 16_384
#: Rows of a stripe at most, and rows that a stripe should have before there are more stripes than cores.
STRIPE, LEAST_STRIPE = 65_536, 2_048
#: Scores computed at once in a task.
TILE = 1 << 21
SCALE = 256


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: all three are given, and so is every component, and finite."""
    v = F.col(vector)
    inf = F.lit(float("inf"))
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & whole)
    kept = kept.select("vec_id", F.struct(F.col("label").alias("label"), v.alias("vector")).alias("row"))
    return kept.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")


def matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """Scaled integer vectors as doubles; shorter ones end in zeros, and what exceeds ``width`` is cut off."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lens = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    most = int(lens.max(initial=0))
    out = np.zeros((len(lens), most))
    out[np.arange(most) < lens[:, None]] = flat
    if width is None or width == most:
        return out
    return out[:, :width] if width < most else np.pad(out, ((0, 0), (0, width - most)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact."""
    bound = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if bound >= 2 ** 53:
        raise ArithmeticError("inner products beyond 2^53 are not exact")
    if bound < 2 ** 24:
        a, b = a.astype(np.float32), b.astype(np.float32)
    return (a @ b.T).astype(np.float64)


class Best:
    """The best ``k`` (score, id) of each of ``n`` keys; higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def worst(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(keys):
            return
        touched = np.unique(keys)
        keys = np.concatenate([keys, np.repeat(touched, self.k)])
        scores = np.concatenate([scores, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -scores, keys))
        keys, scores, ids = keys[order], scores[order], ids[order]
        first = np.searchsorted(keys, keys)
        place = np.arange(len(keys)) - first
        top = place < self.k
        self.scores[keys[top], place[top]] = scores[top]
        self.ids[keys[top], place[top]] = ids[top]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, scores and ids of what is kept."""
        key, place = np.nonzero(self.scores > -np.inf)
        return key, self.scores[key, place].astype(np.int64), self.ids[key, place]


def _tiles(block: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """(scores, rows) tiles; the first are small, so that later ones meet what is worth keeping."""
    size = 64
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size)
            yield products(block, matrix(part["vector"], block.shape[1])), part
            at, size = at + size, min(size * 4, max(64, TILE // max(1, len(block))))


def _cells(spark: SparkSession, anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Anchors (kind 0) and rows (kind 1) of every cell, together and anchors first."""
    blocks = -(-n_anchors // ANCHOR_BLOCK)
    cores = spark.sparkContext.defaultParallelism
    stripes = max(-(-n_rows // STRIPE), min(-(-n_rows // LEAST_STRIPE), -(-2 * cores // blocks)), 1)
    block, stripe = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(stripes))
    extra = [c for c in anchors.columns if c not in ("vec_id", "label", "vector")]
    left = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), block.alias("block"), F.lit(0).alias("kind"), "vec_id", "label", "vector", *extra)
    right = rows.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), stripe.alias("stripe"), F.lit(1).alias("kind"), "vec_id", "label", "vector")
    cell = (F.col("block") * stripes + F.col("stripe")).cast("long")
    both = left.unionByName(right, allowMissingColumns=True).withColumn("cell", cell).drop("block", "stripe")
    return both.repartition(min(blocks * stripes, 1 << 20), "cell").sortWithinPartitions("cell", "kind")


def _per_cell(fn: Callable[[pa.Table, Iterator[pa.RecordBatch]], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` on the anchors and the stream of rows of each cell that has both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = groups(batches, ["cell", "kind"])
        held: tuple[int, pa.Table] | None = None
        for (cell, kind), part in parts:
            if kind == 0:
                held = cell, pa.Table.from_batches(part)
            elif held is not None and held[0] == cell:
                yield fn(held[1], part)
    return run


def _positives(k: int) -> Callable[[pa.Table, Iterator[pa.RecordBatch]], pa.RecordBatch]:
    def run(anchors: pa.Table, batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        block, ids = matrix(anchors["vector"]), anchors["vec_id"].to_numpy()
        labels = anchors["label"].to_numpy()
        best = Best(len(ids), k)
        for scores, rows in _tiles(block, batches):
            others = rows["vec_id"].to_numpy()
            good = (scores >= best.worst()[:, None]) & (labels[:, None] == rows["label"].to_numpy()) & (ids[:, None] != others)
            a, r = np.nonzero(good)
            best.add(a, scores[a, r], others[r])
        key, scores, found = best.rows()
        return pa.RecordBatch.from_arrays([pa.array(ids[key]), pa.array(found), pa.array(scores)], ["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(k: int, slots: int, low: int, high: int) -> Callable[[pa.Table, Iterator[pa.RecordBatch]], pa.RecordBatch]:
    def run(anchors: pa.Table, batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        block, ids = matrix(anchors["vector"]), anchors["vec_id"].to_numpy()
        labels, n = anchors["label"].to_numpy(), len(anchors)
        limits = np.full((n, slots + 1), -np.inf)
        least = np.empty(n)
        for i, scores in enumerate(anchors["scores"].to_pylist()):
            # Scores come in descending order, and so do their limits; missing positives have empty slots.
            limits[i, :slots] = [high * s // 100 for s in scores] + [-np.inf] * (slots - len(scores))
            least[i] = min(-(-low * s // 100) for s in scores)
        kept = [Best(n, k) for _ in range(slots)]
        for scores, rows in _tiles(block, batches):
            others = rows["vec_id"].to_numpy()
            open_ = (scores <= limits[:, :1]) & (scores >= least[:, None]) & (labels[:, None] != rows["label"].to_numpy())
            for j, best in enumerate(kept):
                floor = np.maximum(best.worst(), np.nextafter(limits[:, j + 1], np.inf))[:, None]
                a, r = np.nonzero(open_ & (scores <= limits[:, j:j + 1]) & (scores >= floor))
                best.add(a, scores[a, r], others[r])
        out = [(ids[key], np.full(len(key), j, np.int32), found, scores) for j, (key, scores, found) in enumerate(b.rows() for b in kept)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["anchor_id", "slot", "negative_id", "negative_score"])
    return run


def mine(spark: SparkSession, rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``rows`` (vec_id, label, vector).

    Anchors are the rows with ``anchor``, a condition on vec_id. A score is the inner product of two vectors with
    components floor(256 * x); higher ones come first, then smaller vec_ids. An anchor's positives are its first
    ``positives`` other rows of its label (all, if fewer); each gets the first ``negatives`` rows of other labels
    (all, if fewer) with ``low * positive_score <= 100 * negative_score <= high * positive_score``, ranked from 1.

    Rows with a null vec_id, label, vector or component, or one that is not finite, take no part. vec_id is a key:
    of several rows with one vec_id that with the least (label, vector) counts. Vectors of different lengths
    meet in their common components, empty ones in none (score 0). Anchors without positives, and positives without
    negatives, give no rows; neither does an empty table. Other columns are ignored. Scores beyond 2^53 are an error.
    """
    scratch = Scratch(spark, "hard-negatives")
    table = scratch.table(usable(rows, vector), "rows")
    asked = table.where(anchor)
    n_rows, n_anchors = table.count(), asked.count()
    kinds = "anchor_id long, positive_id long, positive_score long"
    found = _cells(spark, asked, table, max(1, n_anchors), n_rows).mapInArrow(_per_cell(_positives(positives)), kinds)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    pairs = F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score")))
    found = scratch.table(found.groupBy("anchor_id").agg(pairs.alias("positives")), "positives")

    anchors = asked.join(found.select(F.col("anchor_id").alias("vec_id"), F.col("positives.positive_score").alias("scores")), "vec_id")
    kinds = "anchor_id long, slot int, negative_id long, negative_score long"
    kept = _cells(spark, anchors, table, max(1, n_anchors), n_rows).mapInArrow(_per_cell(_negatives(negatives, positives, low, high)), kinds)
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
    kept = kept.withColumn("place", F.row_number().over(best)).where(F.col("place") <= negatives)
    # Best first; the rows that a positive may take are a suffix of this list, from its own slot on.
    entry = F.struct((-F.col("negative_score")).alias("down"), F.col("negative_id").alias("negative_id"), F.col("slot").alias("slot"))
    kept = kept.groupBy("anchor_id").agg(F.array_sort(F.collect_list(entry)).alias("kept"))
    asked_by = found.select("anchor_id", F.explode("positives").alias("p")).select("anchor_id", "p.*")
    suffix = F.filter("kept", lambda e: (e["slot"] >= F.col("place") - 1) & (F.col("positive_score") * low <= e["down"] * -100) & (e["down"] * -100 <= F.col("positive_score") * high))
    answer = asked_by.join(kept, "anchor_id").select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(suffix, 1, negatives)).alias("pos", "e"))
    return answer.select("anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.negative_id").alias("negative_id"),
                         "positive_score", (-F.col("e.down")).alias("negative_score"))
