"""One user holding a third of all events: results stay exact (checked against DuckDB on the same rows)."""

import tempfile

import duckdb
from pyspark.sql import functions as F

from conftest import SF01
import os, sys  # noqa: E401
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import rows_of  # noqa: E402
from shelfrank.operators import catalog, clean, feed, matrix
from shelfrank.plans import registry as R
from shelfrank.sources import testdata as td


def test_hot_user_results_are_exact(spark):
    raw = td.interactions(spark, SF01).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    path = tempfile.mkdtemp(prefix="skew-", dir="/tmp") + "/log.parquet"
    raw.write.parquet(path)
    log = clean.clean_interactions(spark.read.parquet(path))
    hot = log.filter("user_id = 0").count()
    assert hot * 3 >= log.count() * 0.9                       # about a third of all rows

    con = duckdb.connect()
    dedup = f"""
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id, interaction_type, session_id
                                                  ORDER BY ts, event_id, rating DESC NULLS LAST) AS rn
                     FROM read_parquet('{path}')) WHERE rn = 1"""
    m_sql = f"""SELECT user_id, product_id, CAST(sum(interaction_score) AS BIGINT) AS total_score, count(*) AS interaction_count
                FROM ({dedup}) GROUP BY 1, 2"""
    got = matrix.user_product_matrix(log).select("user_id", "product_id", "total_score", "interaction_count")
    rel = con.sql(m_sql)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(rel.columns, rel.fetchall())

    hist = feed.recent_interactions(log)
    assert hist.filter("user_id = 0").count() == 50
    h_sql = f"""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
                FROM ({dedup})) WHERE r <= 50"""
    rel = con.sql(h_sql)
    g = hist.select("user_id", "event_id")
    assert rows_of(g.columns, [tuple(r) for r in g.collect()]) == rows_of(rel.columns, rel.fetchall())

    pop = catalog.product_popularity(log)
    p_sql = f"""SELECT product_id, CAST(sum(interaction_score) AS BIGINT) AS popularity_score, count(*) AS total_interactions,
                count(DISTINCT user_id) AS unique_users FROM ({dedup}) GROUP BY 1"""
    rel = con.sql(p_sql)
    assert rows_of(pop.columns, [tuple(r) for r in pop.collect()]) == rows_of(rel.columns, rel.fetchall())
    # the feed for the hot user is bounded by its 50-event history
    c = R.Ctx(spark, SF01)
    slots = feed.feed_slots(feed.time_decay_weights(hist, feed.latest_ts(log)))
    out = feed.personal_feed(slots, c.similar, c.complementary, c.products, c.user_cats, c.popular)
    assert out.filter("user_id = 0").count() <= 14
