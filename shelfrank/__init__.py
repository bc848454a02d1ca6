"""Recommendation analytics as Spark DataFrame operators.

Subpackages:
  sources    -- input adapters, file readers and writers, result lookups
  functions  -- column-level building blocks (pure ``pyspark.sql.functions``)
  operators  -- one function per operator: DataFrames and parameters in, one DataFrame out
  plans      -- whole runs built from operators, session and sizing helpers
  streaming  -- Structured Streaming versions of the stateful operators
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python tasks (mapInPandas, applyInPandas) run
    on executors that do not have the package installed."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a hard dependency
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
