"""Running the streams: sources, sinks and the per-batch refresh hooks (ST7, ST8).

Outputs go to folders under a root that lives in the session's checkpoint folder (shared storage
on a cluster), one subfolder per run. Each micro-batch writes (overwrites) its own ``batch_id=N``
folder, so a re-run batch is idempotent; readers take the latest row per key. Sinks are written by the executors; nothing is collected.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfrank.plans.session import checkpoint_dir


def run_root(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def events_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The raw event files of ``folder`` as a stream (schema taken from the files once)."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def _late_rows(query) -> int:
    """Wait for a query; the rows that its stateful operators dropped behind the watermark. Progress is read while
    the query runs, as Spark keeps that of the last batches only."""
    dropped: dict[int, int] = {}
    while True:
        ended = query.awaitTermination(1)
        for p in query.recentProgress:
            dropped[p["batchId"]] = max(dropped.get(p["batchId"], 0), sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", [])))
        if ended:
            return sum(dropped.values())


def _note_late(spark: SparkSession, root: str, name: str, rows: int) -> None:
    """One row (stream, late_rows) below <root>/late for each run of a stream."""
    spark.createDataFrame([(name, rows)], "stream string, late_rows long").write.mode("append").parquet(f"{root}/late")


def run_available(stream: DataFrame, root: str, on_batch=None, output_mode: str = "update", state_store: str | None = None) -> None:
    """Process everything available now, writing each batch to its own folder below <root>/out.
    ``on_batch(rows, batch_id)`` gets the rows as written, read back: whatever the hook computes, the
    stateful operators run once for each batch. ``state_store`` is the provider of this query's state store."""
    out, spark = f"{root}/out", stream.sparkSession

    def write(df: DataFrame, batch_id: int) -> None:
        # Each batch overwrites its own folder: a batch re-run after a failure replaces its rows
        # instead of adding them again. Readers get ``batch_id`` back from the folder names.
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if on_batch is not None:
            on_batch(spark.read.schema(df.schema).parquet(f"{out}/batch_id={batch_id}"), batch_id)

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    if state_store is not None:
        spark.conf.set(name, state_store)
    try:
        run_available_with([("out", stream, write, output_mode)], root)
    finally:
        spark.conf.set(name, before)


def run_available_with(streams: list, root: str) -> None:
    """Start several streams over the data available now and wait for all of them. Each entry is
    (name, stream, foreachBatch hook, output mode); checkpoints go to <root>/checkpoint-<name>."""
    queries = []
    for name, stream, hook, mode in streams:
        queries.append((name, stream.sparkSession, stream.writeStream.outputMode(mode).foreachBatch(hook)
                        .option("checkpointLocation", f"{root}/checkpoint-{name}")
                        .trigger(availableNow=True).start()))
    for name, spark, q in queries:
        _note_late(spark, root, name, _late_rows(q))


def run_to_files(stream: DataFrame, root: str, name: str) -> None:
    """Append a stream's rows, available now, to Parquet files below <root>/<name>: another stream that reads the folder
    sees the files of committed batches, each once."""
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", f"{root}/{name}")
         .option("checkpointLocation", f"{root}/checkpoint-{name}").trigger(availableNow=True).start())
    _note_late(stream.sparkSession, root, name, _late_rows(q))
