"""Physical plan checks: top-k inside windows, pushed filters, pruned columns, no per-row Python."""

import contextlib
import io
import tempfile

import __spark_entry__ as E
from conftest import SF01
from shelfrank.operators import catalog, clean
from shelfrank.plans.registry import QUERIES
from shelfrank.sources import testdata as td

# Queries whose construction runs no job (model and stream queries run theirs while building).
PLANNED = [n for n in QUERIES if not (n.startswith("stream_") or n in {
    "nmf_factors", "recommend_top_n", "model_metrics", "als_recommendations", "export_recommendations",
    "lookup_recommendations"})]


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


PLANS: dict[str, str] = {}


def planned(spark, name):
    """The plan of a query, built once for all tests."""
    if name not in PLANS:
        PLANS[name] = plan(E.queries()[name](spark, SF01))
    return PLANS[name]


def test_topk_runs_as_window_group_limit(spark):
    for name in ["popular_by_category", "similar_products", "complementary_products", "recent_interactions"]:
        assert "WindowGroupLimit" in plan(E.queries()[name](spark, SF01)), name


def test_threshold_reaches_the_parquet_scan(spark):
    path = tempfile.mkdtemp(prefix="products-", dir="/tmp") + "/p"
    clean.clean_products(td.products(spark, SF01)).write.parquet(path)
    p = plan(catalog.top_rated(spark.read.parquet(path)))
    assert "GreaterThanOrEqual(rating_count,50)" in p
    assert "TakeOrderedAndProject" in p
    assert "stock" not in p.split("ReadSchema:")[1].split("\n")[0]     # pruned column


def test_event_type_filter_is_pushed(spark):
    p = plan(E.queries()["clean_interactions"](spark, SF01))
    assert "PushedFilters: [In(event_type" in p
    assert "value:" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_no_row_at_a_time_python(spark):
    for name in PLANNED:
        p = planned(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_no_cross_joins(spark):
    for name in PLANNED:
        p = planned(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
