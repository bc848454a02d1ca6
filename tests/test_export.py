"""Exports written by executors, read back, cached, reloaded; lookups with unknown keys."""

import json
import tempfile

from pyspark.sql import functions as F

from conftest import SF01
from shelfrank.plans import registry as R
from shelfrank.sources import export, files, lookup


def test_export_read_back_lookup_and_reload(spark):
    root = tempfile.mkdtemp(prefix="results-", dir="/tmp")
    sim = export.export_similar(R.similar_of(spark, SF01))
    files.write_json(sim, f"{root}/similar")
    store = lookup.ResultStore(spark, root)
    back = store.load("similar")
    assert back.count() == sim.count()
    keys = spark.createDataFrame([(1,), (10 ** 9,)], "source_product_id long")
    got = {r.source_product_id: r.items for r in lookup.lookup(back, "source_product_id", keys).collect()}
    assert len(got[1]) == 5 and got[10 ** 9] == []
    # a new run overwrites the folder; reload sees it
    files.write_json(sim.limit(3), f"{root}/similar")
    store.reload()
    assert store.load("similar").count() == 3


def test_keyed_lists_keep_rank_order_and_zero_defaults(spark):
    df = spark.createDataFrame([(1, 2, 7, None), (1, 1, 8, 2.5)], "user_id long, rec_rank int, product_id long, price double")
    recs = df.select("user_id", "rec_rank", "product_id", F.lit("n").alias("product_name"), F.lit("c").alias("category"),
                     F.lit("s").alias("sub_category"), F.lit("b").alias("brand"), "price",
                     F.lit(None).cast("double").alias("avg_rating"), F.lit(1.0).alias("predicted_score"))
    row = export.export_recommendations(recs).first()
    assert [i.product_id for i in row["items"]] == [8, 7]
    assert row["items"][1].price == 0.0 and row["items"][0].avg_rating == 0.0
    line = export.to_json_lines(export.export_recommendations(recs)).first().json
    assert json.loads(line)["user_id"] == 1
