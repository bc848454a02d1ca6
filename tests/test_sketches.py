"""Mergeable distinct users: measured error, merged parts, bounded stream state."""

from pyspark.sql import functions as F

from conftest import SF001
from shelfrank.operators import catalog
from shelfrank.plans import registry as R
from shelfrank.sources import testdata as td
from shelfrank.streaming import refresh, runner

SF1 = "/root/testdata/sf0.1"


def test_error_and_merged_parts(spark):
    """Every product of the order log of sf0.1, and one bought by all 15,000 users."""
    log = R.order_log(spark, SF1).select("user_id", "product_id", "interaction_score")
    log = log.unionByName(log.select("user_id", F.lit(0).cast("long").alias("product_id"), "interaction_score")).persist()
    exact = {r["product_id"]: tuple(r)[1:] for r in catalog.product_popularity(log).collect()}
    even = F.col("user_id") % 2 == 0
    parts = [catalog.popularity_sketches(log.filter(even)), catalog.popularity_sketches(log.filter(~even | (F.col("user_id") % 3 == 0)))]
    whole = {r["product_id"]: tuple(r)[1:] for r in catalog.estimated_users(catalog.popularity_sketches(log)).collect()}
    merged = {r["product_id"]: r["unique_users"] for r in catalog.estimated_users(catalog.merge_sketches(*parts)).collect()}
    log.unpersist()
    assert exact.keys() == whole.keys() and all(whole[p][:2] == exact[p][:2] for p in exact)
    errors = [abs(whole[p][2] - exact[p][2]) / exact[p][2] for p in exact]
    assert exact[0][2] > 9_000 and errors[list(exact).index(0)] < 0.05
    assert max(errors) < 0.05 and sum(errors) / len(errors) < 0.001
    assert merged == {p: v[2] for p, v in whole.items()}  # users that both parts have count once


def test_stream_with_sketches(spark):
    root = runner.run_root(spark, "sketches")
    c = R.Ctx(spark, SF001)
    hook = refresh.PopularRefresher(spark, c.products, root)
    stream = refresh.approximate_popularity_stream(td.state_events(runner.events_stream(spark, SF001, "events.parquet")))
    runner.run_available_with([("both", stream, hook.hook_both, "update")], root)
    got = sorted(map(str, refresh.current(spark, f"{root}/popular").collect()))
    assert got == sorted(map(str, c.popular.collect()))  # so few users that the estimates are exact
