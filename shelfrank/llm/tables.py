"""Intermediate tables in the shared folder, and small helpers around Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.plans.session import checkpoint_dir
from shelfrank.plans.store import drop


class Scratch:
    """A fresh folder below ``spark.checkpoint.dir`` for the tables of one operator run.

    A written table cuts the lineage: when an executor is lost, later stages read the table again
    and only the tasks that were running are repeated.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back with the same schema."""
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that no later stage reads."""
        for name in names:
            drop(self.spark, f"{self.path}/{name}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function from a function of one batch; empty batches give no output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """Consecutive rows of equal ``keys`` from batches sorted by them, as (key, slices) pairs.

    The slices of a group come one batch at a time, so a group is never held whole.
    """
    def pieces() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in keys]
            rows, at = list(zip(*cols)), 0
            for i in range(1, len(rows) + 1):
                if i == len(rows) or rows[i] != rows[at]:
                    yield rows[at], batch.slice(at, i - at)
                    at = i

    stream = pieces()
    held = next(stream, None)
    while held is not None:
        key = held[0]

        def group() -> Iterator[pa.RecordBatch]:
            nonlocal held
            while held is not None and held[0] == key:
                yield held[1]
                held = next(stream, None)

        part = group()
        yield key, part
        for _ in part:  # what the consumer left unread
            pass


def replaced(text: Column, spans: Column, start: str, end: str, mask: str) -> Column:
    """``text`` with every span (code points, end exclusive, sorted by start) replaced by ``mask``, overlapping
    ones together. Without spans the text stays as it is."""
    first = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        piece = F.concat(state["done"], F.substr(text, state["at"] + 1, span[start] - state["at"]), F.lit(mask))
        return F.struct(F.when(span[start] >= state["at"], piece).otherwise(state["done"]).alias("done"),
                        F.greatest(state["at"], span[end]).alias("at"))

    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, lambda s: F.concat(s["done"], F.substr(text, s["at"] + 1)))).otherwise(text)


#: Bits of a key filter; its 16 MB are all that a filter ever takes, however many keys there are.
FILTER_BITS = 27


def filter_slot(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND((1 << FILTER_BITS) - 1)


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the slots of ``column``, combined on the executors. It passes every key of the table
    and few others; with very many keys it passes more, and only saves less."""
    slot = filter_slot(F.col(column))
    parts = keys.select(F.shiftright(slot, 6).alias("word"), F.expr("1L").alias("one"), slot.bitwiseAND(63).cast("int").alias("bit"))
    got = parts.select("word", F.expr("shiftleft(one, bit)").alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    words[got["word"].to_numpy()] = got["mask"].to_numpy()
    return words


def passes(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (words[slots >> 6] >> (slots & 63)) & 1 == 1
