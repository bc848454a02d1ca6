"""The whole batch run on reference-shaped CSV inputs (string ratings, literal complementary map)."""

import contextlib
import io
import tempfile

from pyspark.sql import functions as F

from shelfrank.operators import matrix, profile
from shelfrank.plans import batch_run
from shelfrank.plans.store import Store
from shelfrank.sources import lookup

SUBS = [("Electronics", "Laptops"), ("Electronics", "Headphones"), ("Electronics", "Tablets"),
        ("Fashion", "Jeans"), ("Fashion", "T-Shirts"), ("Books", "Fiction")]
TYPES = [("view", 1), ("click", 2), ("add_to_cart", 3), ("purchase", 5)]


def write(folder, name, header, rows):
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")
    return f"{folder}/{name}.csv"


def fixture():
    d = tempfile.mkdtemp(prefix="refshape-", dir="/tmp")
    users = [(u, "25-34", "City", SUBS[u % 6][0], "Gold", "2024-01-01") for u in range(1, 9)]
    products = []
    for p in range(1, 25):
        cat, sub = SUBS[p % 6]
        products.append((p, f"Brand{p % 3} Pro {sub[:-1]}", cat, sub, f"Brand{p % 3}", 100.0 + p * 37.5,
                         "Budget", round(2.5 + (p * 7 % 26) / 10, 1), 20 + p * 13, p % 5))
    inter = []
    for i in range(120):
        u, p = 1 + i % 8, 1 + (i * 7) % 24
        t, s = TYPES[i % 4]
        rating = (1 + i % 5) if t == "purchase" else ("" if i % 3 else None)
        inter.append((u, p, t, s, rating, None, f"2024-03-{1 + i % 28:02d} {i % 24:02d}:00:00", f"s{u}-{i % 28}"))
    return (write(d, "users", "user_id,age_group,location,preferred_category,membership_type,signup_date", users),
            write(d, "products", "product_id,product_name,category,sub_category,brand,price,price_range,avg_rating,"
                                 "rating_count,stock", products),
            write(d, "interactions", "user_id,product_id,interaction_type,interaction_score,rating,review_sentiment,"
                                     "timestamp,session_id", inter))


def test_batch_run_end_to_end(spark):
    inputs = batch_run.from_csv(spark, *fixture())
    r = batch_run.build_results(spark, inputs, k=3, max_iter=8)
    out = tempfile.mkdtemp(prefix="results-", dir="/tmp")
    assert batch_run.write_results(spark, r, out) == 1
    store = lookup.ResultStore(spark, out)
    assert store.load("products").count() == 24 and len(store.names()) == 6
    recs = store.load("recommendations").collect()
    seen = {(x.user_id, x.product_id) for x in r.split.collect()}
    assert recs and all(len(x["items"]) <= 5 for x in recs)
    assert not any((x.user_id, i.product_id) in seen for x in recs for i in x["items"])
    cat_of = {x.product_id: x.sub_category for x in r.products.collect()}
    comp = {x.source_product_id: [i.sub_category for i in x["items"]] for x in store.load("complementary_products").collect()}
    laptop = next(p for p, s in cat_of.items() if s == "Laptops")
    assert set(comp[laptop]) <= {"Headphones", "Tablets", "Smartwatches"}
    sim = {x.source_product_id: [i.product_id for i in x["items"]] for x in store.load("similar_products").collect()}
    assert all(cat_of[q] == cat_of[p] and q != p for p, lst in sim.items() for q in lst)
    assert all(t.rating_count >= 50 for t in store.load("top_rated").collect())
    m = r.metrics.first()
    assert m.iterations >= 1 and m.rmse >= 0
    counts = {x.metric: x.value for x in batch_run.run_summary(inputs, r).collect()}
    assert counts["users"] == 8 and counts["products"] == 24 and counts["raw_interactions"] == 120


def test_shared_inputs_are_computed_once(spark):
    """Every result reads stored rows: none scans the CSV log or dedups it again. The CSV log has no event
    ids, and the feed runs on it."""
    r = batch_run.build_results(spark, batch_run.from_csv(spark, *fixture()), k=2, max_iter=2)
    for name in ("recommendations", "popular", "similar", "complementary", "metrics", "feed", "interactions"):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            getattr(r, name).explain("formatted")
        assert "Scan csv" not in text.getvalue(), name
    rows = r.feed.collect()
    assert rows and all(1 <= x.position <= 14 for x in rows)
    assert r.interactions.groupBy("event_id").count().filter("count > 1").count() == 0


def test_counts_come_from_the_writes(spark):
    """A10 and A15 equal their scans, and their plans read no stored log, users, products or split, and only the matrix's user ids."""
    inputs = batch_run.from_csv(spark, *fixture())
    r = batch_run.build_results(spark, inputs, k=2, max_iter=2)
    scans = profile.run_summary(r.users, r.products, inputs.interactions, r.interactions, r.matrix)
    want = {x.metric: float(x.value) for x in scans.collect()} | {x.metric: x.value for x in profile.model_summary(r.metrics, r.recommendations).collect()}
    summary = batch_run.run_summary(inputs, r)
    assert {x.metric: x.value for x in summary.collect()} == want and len(want) == summary.count() == 9
    assert batch_run.split_counts(r).collect() == matrix.split_counts(r.split).collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        summary.explain("formatted")
        batch_run.split_counts(r).explain("formatted")
    read = {line for line in text.getvalue().splitlines() if line.startswith("ReadSchema")}
    assert read == {"ReadSchema: struct<>", "ReadSchema: struct<user_id:bigint>", "ReadSchema: struct<rmse:double,mae:double>"}


def test_store_counts_what_it_writes(spark):
    store = Store(spark, "counted")
    df = spark.range(1000).withColumn("even", F.col("id") % 2 == 0)
    kept = store.table(df.repartition(7), "numbers", rows=F.count(F.lit(1)), even=F.count_if(F.col("even")))
    assert store.seen == {"numbers": {"rows": 1000, "even": 500}} and kept.count() == 1000 and kept.dtypes == df.dtypes
    store.table(df.where("id < 0"), "none", rows=F.count(F.lit(1)), even=F.count_if(F.col("even")))
    store.table(df, "plain")
    assert store.seen["none"] == {"rows": 0, "even": 0} and "plain" not in store.seen
