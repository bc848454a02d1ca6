import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from shelfrank.plans.session import build_session
    yield build_session(master="local[8]", shuffle_partitions=8)


@pytest.fixture
def docs(spark):
    """A documents table from texts, or from (doc_id, text) pairs, in four partitions."""
    def make(rows, extra=False):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(4)
        if extra:  # names that the operators use inside
            for name in ("node", "part", "tail", "bucket", "score", "label", "n", "text_1", "component"):
                from pyspark.sql import functions as F
                df = df.withColumn(name, F.lit("x"))
        return df
    return make
