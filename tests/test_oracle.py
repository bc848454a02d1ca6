"""Every registered query with a DuckDB twin gives the same rows at sf0.01 (the driver's check)."""

from conftest import SF01
import os, sys  # noqa: E401
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import check  # noqa: E402

import __spark_entry__ as E  # noqa: E402


def test_all_twins_match(spark):
    names = sorted(E.oracle_sql())
    res = check(spark, SF01, names, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "match"}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["category", "rank", "product_id"]
