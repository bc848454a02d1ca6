"""Reading result sets back and key lookups.

``ResultStore`` reads one complete version of the result sets (``results``), keeps what it has loaded cached by name, and
moves to the newest complete version when told to (S15). A lookup joins the requested keys to a keyed export; a key
without an entry gets an empty list, as the reference's server answers an unknown id (S17-S19).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.sources import results


class ResultStore:
    """The result sets of one version below ``root``: by default the newest complete one at the first read. Later runs, complete or
    not, change nothing until ``reload``. A folder without versions is read as plain sets, ``<root>/<name>``."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version
        self._sets: dict | None = None
        self._cache: dict[str, DataFrame] = {}

    def _open(self) -> dict:
        if self._sets is None:
            if self.version is None:
                self.version = results.newest(self.spark, self.root)
            self._sets = {} if self.version is None else results.read_version(self.spark, self.root, self.version)
            if self.version is not None and not self._sets:
                raise FileNotFoundError(f"no version {self.version} below {self.root}")
        return self._sets

    def names(self) -> list[str]:
        return sorted(self._open())

    def load(self, name: str) -> DataFrame:
        """The result set of that name, cached after the first read."""
        if name not in self._cache:
            known = self._open()
            if self.version is None:
                rows = self._plain(name)
            else:
                path, schema = known[name]
                rows = self.spark.read.schema(schema).json(path)
            self._cache[name] = rows.cache()
        return self._cache[name]

    def _plain(self, name: str) -> DataFrame:
        try:
            return self.spark.read.json(f"{self.root}/{name}")
        except AnalysisException as e:
            raise FileNotFoundError(f"no complete result sets and no {name} below {self.root}") from e

    def reload(self) -> int | None:
        """Drop every cached result set and move to the newest complete version; return it."""
        for df in self._cache.values():
            df.unpersist()
        if self.version is None:
            for name in self._cache:
                self.spark.catalog.refreshByPath(f"{self.root}/{name}")
        self._cache.clear()
        self._sets, self.version = None, None
        self._open()
        return self.version


def lookup(keyed: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """For each requested key its list, or an empty list when the key is unknown."""
    items_type = keyed.schema["items"].dataType
    return (keys.select(key).distinct().join(keyed, key, "left")
            .select(key, F.coalesce("items", F.array().cast(items_type)).alias("items")))
