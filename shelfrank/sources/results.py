"""Versioned result sets (S14-S16): all sets of a run under one folder, and a manifest written last.

    <root>/runs/<run>/<name>            JSON lines of one result set
    <root>/manifests/version=<n>        one row for each set: run, name, rows, schema

A version exists when its manifest does. So a reader never sees a run that is being written or that broke off half-way, and
one that has pinned a version goes on reading it while the next is written. Numbers are given by the manifests: two
runs that end at once can't both become the same version.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfrank.plans.store import drop
from shelfrank.sources import files

MANIFEST = "run string, name string, rows long, schema string"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """(version, run, name, rows, schema) of all complete versions."""
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/manifests").select(F.col("version").cast("long").alias("version"), "run", "name", "rows", "schema")
    except AnalysisException:
        return spark.createDataFrame([], f"version long, {MANIFEST}")


def newest(spark: SparkSession, root: str) -> int | None:
    """The last complete version below ``root``, or None."""
    return manifests(spark, root).agg(F.max("version")).first()[0]


def write_version(spark: SparkSession, root: str, sets: dict[str, DataFrame]) -> int:
    """Write the result sets as JSON lines and then their manifest; return the version. The rows of a set are counted by the
    write itself. Column types are kept in the manifest, so an empty set, and a column of nulls, read back as they were."""
    root, run = root.rstrip("/"), uuid.uuid4().hex
    rows = []
    for name, df in sets.items():
        seen = Observation()
        files.write_json(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/runs/{run}/{name}")
        rows.append((run, name, seen.get["rows"], df.schema.json()))
    manifest = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    while True:
        version = (newest(spark, root) or 0) + 1
        try:
            manifest.write.mode("errorifexists").parquet(f"{root}/manifests/version={version}")
            return version
        except AnalysisException as e:  # another run has just become this version
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the last ``keep`` versions, manifests first; return the numbers of those deleted. Runs without a manifest are
    left alone, as they may be in writing."""
    known = sorted({(r["version"], r["run"]) for r in manifests(spark, root).select("version", "run").collect()})
    old = known[:-keep] if keep else known
    for version, _ in old:
        drop(spark, f"{root.rstrip('/')}/manifests/version={version}")
    for _, run in old:
        drop(spark, f"{root.rstrip('/')}/runs/{run}")
    return [version for version, _ in old]


def read_version(spark: SparkSession, root: str, version: int) -> dict[str, tuple[str, StructType]]:
    """Path and schema of each result set of a version."""
    rows = manifests(spark, root).filter(F.col("version") == version).collect()
    return {r["name"]: (f"{root.rstrip('/')}/runs/{r['run']}/{r['name']}", StructType.fromJson(json.loads(r["schema"]))) for r in rows}
