"""Versions of result sets: complete or not there at all."""

import tempfile

import pytest
from pyspark.sql import functions as F

from shelfrank.sources import results
from shelfrank.sources.lookup import ResultStore


def sets(spark, tag, rows=3):
    table = spark.range(rows).select(F.col("id").alias("user_id"), F.lit(tag).alias("tag"), F.array(F.struct("id")).alias("items"))
    return {"a": table, "b": table.filter("user_id > 0"), "none": table.filter("user_id < 0").withColumn("x", F.lit(None).cast("double"))}


def test_readers_pin_a_version_and_move_on_reload(spark):
    root = tempfile.mkdtemp(prefix="versions-", dir="/tmp")
    with pytest.raises(FileNotFoundError):
        ResultStore(spark, root).load("a")
    assert results.write_version(spark, root, sets(spark, "old")) == 1
    store, other = ResultStore(spark, root), ResultStore(spark, root, version=1)
    assert {r.tag for r in store.load("a").collect()} == {"old"}
    assert results.write_version(spark, root, sets(spark, "new", 5)) == 2
    assert store.load("b").count() == 2 and {r.tag for r in store.load("b").collect()} == {"old"}
    assert store.reload() == 2
    assert {r.tag for r in store.load("a").collect()} == {"new"} and store.load("a").count() == 5
    assert {r.tag for r in other.load("a").collect()} == {"old"}
    rows = {(r["version"], r["name"]): r["rows"] for r in results.manifests(spark, root).collect()}
    assert rows == {(1, "a"): 3, (1, "b"): 2, (1, "none"): 0, (2, "a"): 5, (2, "b"): 4, (2, "none"): 0}
    assert store.load("none").dtypes == sets(spark, "x")["none"].dtypes and store.load("none").count() == 0


def test_a_run_that_breaks_off_is_not_seen(spark):
    root = tempfile.mkdtemp(prefix="versions-", dir="/tmp")
    results.write_version(spark, root, sets(spark, "old"))
    store = ResultStore(spark, root)
    store.load("a")
    broken = {**sets(spark, "new"), "last": spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("killed"))).otherwise(F.lit("x")).alias("v"))}
    with pytest.raises(Exception, match="killed"):
        results.write_version(spark, root, broken)
    assert store.reload() == 1 and store.names() == ["a", "b", "none"]
    assert {r.tag for r in store.load("a").collect()} == {"old"}
    assert results.write_version(spark, root, sets(spark, "next")) == 2


def test_runs_that_end_at_once_get_different_versions(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="versions-", dir="/tmp")
    results.write_version(spark, root, sets(spark, "one"))
    real, early = results.newest, [None]  # the first look is too early: it sees no version yet
    monkeypatch.setattr(results, "newest", lambda s, r: early.pop() if early else real(s, r))
    assert results.write_version(spark, root, sets(spark, "two")) == 2
    monkeypatch.undo()
    assert results.newest(spark, root) == 2


def test_old_versions_are_pruned(spark):
    root = tempfile.mkdtemp(prefix="versions-", dir="/tmp")
    for k in range(4):
        results.write_version(spark, root, sets(spark, f"v{k}"))
    assert results.prune(spark, root, keep=2) == [1, 2]
    assert {r["version"] for r in results.manifests(spark, root).collect()} == {3, 4}
    assert {r.tag for r in ResultStore(spark, root, version=3).load("a").collect()} == {"v2"}
    assert results.write_version(spark, root, sets(spark, "v4")) == 5
