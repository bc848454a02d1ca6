"""Tables that several results share, written once to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from shelfrank.plans.session import checkpoint_dir


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Store:
    """A folder of its own below the checkpoint folder. ``table`` writes a DataFrame there and reads it
    back: whatever reads it later starts from the stored rows, also after the loss of an executor.

    ``figures`` are aggregates of the written rows that the write itself computes, kept in ``seen[name]``. They are taken in the
    last stage of the write, of which each partition counts once, whatever tasks and executors are lost. Distinct
    counts are not possible there."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self.seen: dict[str, dict[str, int]] = {}

    def table(self, df: DataFrame, name: str, **figures: Column) -> DataFrame:
        seen = Observation()
        made = df.observe(seen, *(c.alias(k) for k, c in figures.items())) if figures else df
        made.write.parquet(f"{self.path}/{name}")
        if figures:
            self.seen[name] = seen.get
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")
