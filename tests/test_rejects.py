"""Rows in = rows kept + rows rejected, and why."""

import tempfile

from pyspark.sql import functions as F

from shelfrank.operators import clean
from shelfrank.sources import files, rejects
from shelfrank.streaming import runner
from test_clean import CSV, write

MORE = "5,15,view,1.5,,,2024-01-04 10:00:00,s7\n6,16\n7,17,view,1,3,,2024-01-04 10:00:00,s8,extra\n 8 , 18 ,view, 1 ,,,,s9\n\"9\",\"19\",\"a,b\",1,,,2024-01-04 10:00:00,s9\n"


def test_every_row_is_kept_or_rejected(spark):
    folder = write(CSV + MORE)
    rows = rejects.checked(rejects.read_text(spark, folder, "interactions"), "interactions")
    why = {(r["user_id"], r["product_id"], r["session_id"]): (sorted(r["reasons"]), r["kept"]) for r in rows.collect()}
    assert why[(None, 13, "s4")] == (["user_id: missing"], False)
    assert why[(None, 14, "s5")] == (["user_id: not a number"], False)
    assert why[(4, None, "s6")] == (["product_id: missing"], False)
    assert why[(3, 12, "s3")] == (["rating: not a number", "timestamp: not a time"], True)
    assert why[(5, 15, "s7")] == (["interaction_score: not a number"], True)
    assert why[(6, 16, None)] == (["row: not the table's number of fields", "timestamp: missing"], True)
    assert why[(7, 17, "s8")] == (["row: not the table's number of fields"], True)
    assert why[(8, 18, "s9")] == (["timestamp: missing"], True) and why[(9, 19, "s9")] == ([], True)
    n = rows.count()
    assert n == 13 and rejects.kept(rows).count() == 10 and rejects.rejected(rows).count() == 3
    count = {r["reason"]: (r["rows"], r["dropped"]) for r in rejects.counts(rows).collect()}
    assert count["any row"] == (13, 3) and count["user_id: missing"] == (1, 1) and count["rating: not a number"] == (1, 0)
    # What is kept is what the typed reader and cleaning keep.
    typed = clean.clean_interactions(files.read_interactions(spark, write(CSV)))
    own = clean.clean_interactions(rejects.kept(rejects.checked(rejects.read_text(spark, write(CSV), "interactions"), "interactions")))
    assert own.columns == typed.columns and sorted(map(str, own.collect())) == sorted(map(str, typed.collect()))


def test_streams_reject_the_same_rows(spark):
    folder = write(CSV + MORE)
    batch = rejects.checked(rejects.read_text(spark, folder, "interactions"), "interactions")
    root = runner.run_root(spark, "rejects")
    runner.run_available(rejects.checked(rejects.read_text(spark, folder, "interactions", stream=True), "interactions"), root, output_mode="append")
    got = spark.read.parquet(f"{root}/out").drop("batch_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))
    # The untimed ones are all that the event stream leaves out.
    events = files.state_events(files.read_interactions(spark, folder))
    assert rejects.kept(got).count() == events.count() + rejects.untimed(got).count()


def test_users_and_products(spark):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    with open(f"{d}/u.csv", "w") as f:
        f.write("user_id,age_group,location,preferred_category,membership_type,signup_date\n1,a,b,c,d,2024-01-01\nx,a,b,c,d,\n,a,b,c,d,\n")
    rows = rejects.checked(rejects.read_text(spark, d, "users"), "users")
    assert {tuple(r["reasons"]) for r in rejects.rejected(rows).collect()} == {("user_id: not a number",), ("user_id: missing",)}
    products = spark.createDataFrame([("1", "n", "9.5", "4", "x"), ("2", " ", "cheap", "", "1")], "product_id string, product_name string, price string, rating_count string, stock string")
    rows = {r["product_id"]: r for r in rejects.checked(products.withColumn("extra", F.lit(1)), "products").collect()}
    assert rows[1]["price"] == 9.5 and rows[1]["reasons"] == ["stock: not a number"] and rows[1]["kept"] and rows[1]["extra"] == 1
    assert rows[2]["reasons"] == ["product_name: missing", "price: not a number"] and rows[2]["price"] is None
    assert rejects.counts(rejects.checked(products.limit(0), "products")).count() == 0
