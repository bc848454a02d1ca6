"""Streams against the batch operators on the same events."""

import glob
import os
import random
import shutil
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from shelfrank.operators import catalog, clean, feed, state
from shelfrank.plans import registry as R
from shelfrank.sources import files
from shelfrank.sources import testdata as td
from shelfrank.streaming import refresh, runner
from shelfrank.streaming import user_state as us


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_feed_equals_batch_feed(spark):
    got = R.q_stream_personal_feed(spark, SF01)
    want = feed.personal_feed(**R.feed_inputs(spark, SF01))
    assert want.count() > 0
    assert same_rows(got, want)


def split_files(spark, events, parts, order):
    """Write events to ``parts`` files that a stream reads one by one: oldest first, newest first or at random."""
    flat = tempfile.mkdtemp(prefix="events-flat-", dir="/tmp")
    rows = events.orderBy("ts", "event_id").toPandas()
    if order == "newest":
        rows = rows.iloc[::-1]
    elif order == "random":
        rows = rows.sample(frac=1, random_state=7)
    step = -(-len(rows) // parts)
    for i in range(parts):
        part = spark.createDataFrame(rows.iloc[i * step:(i + 1) * step], events.schema).coalesce(1)
        folder = tempfile.mkdtemp(prefix="events-part-", dir="/tmp")
        part.write.parquet(f"{folder}/p")
        shutil.copy(glob.glob(f"{folder}/p/*.parquet")[0], f"{flat}/events-{i}.parquet")
        os.utime(f"{flat}/events-{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    return flat


def doubled(events):
    """The events, and copies of every third one an hour and a day later or earlier under new ids (a copy
    of the same day has the same session)."""
    again = events.filter(F.col("event_id") % 3 == 0)
    hour = again.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")).withColumn("event_id", F.col("event_id") + 100_000)
    early = again.withColumn("ts", F.col("ts") - F.expr("INTERVAL 20 MINUTE")).withColumn("event_id", F.col("event_id") + 200_000)
    day = again.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).withColumn("event_id", F.col("event_id") + 300_000)
    return events.union(hour).union(early).union(day)


@pytest.mark.parametrize("order,chunk", [("oldest", 10_000), ("newest", 20), ("random", 10_000), ("random", 20)])
def test_state_does_not_depend_on_order_or_chunks(spark, monkeypatch, order, chunk):
    events = doubled(spark.read.parquet(f"{SF001}/events.parquet"))
    flat = split_files(spark, events, 4, order)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(chunk))
    try:
        root = runner.run_root(spark, "order-test")
        runner.run_available(us.user_state_stream(td.state_events(runner.events_stream(spark, flat, "events-*.parquet", 1))), root)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    out = spark.read.parquet(f"{root}/out")
    assert out.select("batch_id").distinct().count() == 4
    snap = us.latest_snapshots(out)
    monkeypatch.setattr(td, "_read", lambda s, d, name: events if name == "events" else s.read.parquet(f"{d}/{name}.parquet"))
    c = R.Ctx(spark, SF001)
    assert same_rows(us.history_rows(snap), c.history)
    assert same_rows(us.list_rows(snap, "wishlist"), c.wishlist)
    assert same_rows(us.list_rows(snap, "cart"), c.cart)
    prefs = feed.name_categories(snap.filter(F.col("pref_event_id").isNotNull()).select(
        "user_id", F.col("pref_event_id").alias("event_id"), "c1", "c2", "n_categories"), c.products)
    assert same_rows(prefs, c.prefs)
    assert snap.agg(F.sum("late_events")).first()[0] == 0


@pytest.mark.parametrize("order", ["oldest", "newest", "random"])
def test_hourly_and_popularity_streams_in_any_order(spark, monkeypatch, order):
    """The earliest copy of a dedup key counts, whenever it comes; scores and users do not depend on the order either."""
    events = doubled(spark.read.parquet(f"{SF001}/events.parquet"))
    flat = split_files(spark, events, 4, order)
    monkeypatch.setattr(td, "_read", lambda s, d, name: events if name == "events" else s.read.parquet(f"{d}/{name}.parquet"))
    c = R.Ctx(spark, SF001)
    stream = lambda: td.state_events(runner.events_stream(spark, flat, "events-*.parquet", 1))
    root = runner.run_root(spark, "hourly-order")
    assert same_rows(refresh.run_hourly(stream(), root), state.hourly_sessions(c.log))
    late = spark.read.parquet(f"{root}/late").union(spark.read.parquet(f"{root}/windows/late"))
    assert late.agg(F.sum("late_rows")).first()[0] == 0
    if order != "oldest":  # something was taken back
        assert spark.read.parquet(f"{root}/changes").filter("delta < 0").count() > 0
    root = runner.run_root(spark, "popular-order")
    hook = refresh.PopularRefresher(spark, c.products, root)
    scores, users = refresh.popularity_streams(stream())
    runner.run_available_with([("scores", scores, hook.hook("scores"), "update"), ("users", users, hook.hook("users"), "update")], root)
    assert same_rows(refresh.current(spark, f"{root}/popular"), c.popular)


def test_unknown_types_have_no_score(spark):
    rows = [("interaction", 1, 7, "like", "s"), ("interaction", 1, 7, "view", "s"), ("interaction", 2, 7, "typo", "s"), ("interaction", 2, 8, "typo", "s")]
    folder = tempfile.mkdtemp(prefix="types-", dir="/tmp")
    df = spark.createDataFrame(rows, "kind string, user_id long, product_id long, interaction_type string, session_id string")
    df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000))).write.parquet(f"{folder}/e")
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/e").schema).parquet(f"{folder}/e")
    root = runner.run_root(spark, "types")
    runner.run_available(refresh.popularity_streams(stream)[0], root)
    got = {tuple(r) for r in spark.read.parquet(f"{root}/out").select("product_id", "popularity_score", "total_interactions").collect()}
    assert got == {(7, 1, 3), (8, None, 1)}


def totals(spark, rows):
    return spark.createDataFrame(rows, "product_id long, popularity_score long, total_interactions long")


def test_popular_lists_are_merged_from_touched_products(spark):
    products = spark.createDataFrame([(i, f"p{i}", "AB"[i % 2], "b", 1.0, 4.0) for i in range(60)],
                                     "product_id long, product_name string, category string, brand string, price double, avg_rating double")
    root = runner.run_root(spark, "merge")
    hook = refresh.PopularRefresher(spark, products, root)
    hook.totals["scores"].every = 3  # a base is written on the way
    write, known = hook.hook("scores"), {}
    rnd = random.Random(2)
    for batch in range(7):
        ids = range(60) if batch == 0 else rnd.sample(range(60), 5)
        for i in ids:  # sometimes a listed product falls: its category is ranked anew
            known[i] = (i, known.get(i, (i, 0, 0))[1] + rnd.choice([1, 5, 40, -60]), batch)
        write(totals(spark, [known[i] for i in ids]), batch)
        assert spark.read.parquet(f"{root}/scores/rows/batch_id={batch}").count() == len(ids)
        assert same_rows(hook.totals["scores"].latest(), totals(spark, list(known.values())))
        want = catalog.rank_popular(totals(spark, list(known.values())).withColumn("unique_users", F.lit(0).cast("long")), products)
        assert same_rows(refresh.current(spark, f"{root}/popular"), want)
    write(totals(spark, [known[i] for i in ids]), 6)  # a batch that is run again replaces itself
    assert same_rows(refresh.current(spark, f"{root}/popular"), want)


def test_late_rows_of_many_batches_are_counted(spark):
    """Spark keeps the progress of a few batches only; the count covers all."""
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "8")
    try:
        rows = [(i, 10_000_000 - i * 100_000) for i in range(24)]
        flat = tempfile.mkdtemp(prefix="late-many-", dir="/tmp")
        for i, ts in rows:
            path = f"{flat}/events-{i}.parquet"
            pd.DataFrame({"id": [i], "ts": [pd.Timestamp(ts, unit="s")]}).to_parquet(path, coerce_timestamps="us")
            os.utime(path, (1_000_000 + i, 1_000_000 + i))
        stream = spark.readStream.schema("id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(flat)
        root = runner.run_root(spark, "late-many")
        runner.run_available(stream.withWatermark("ts", "1 hour").groupBy("ts").count(), root)
        assert spark.read.parquet(f"{root}/late").first()["late_rows"] == 22  # the watermark holds from the third batch on
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_late_events_are_counted_not_lost_silently(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    flat = split_files(spark, events, 4, "newest")
    root = runner.run_root(spark, "late-test")
    runner.run_available(us.user_state_stream(td.state_events(runner.events_stream(spark, flat, "events-*.parquet", 1)), "1 hour"), root)
    snap = us.latest_snapshots(spark.read.parquet(f"{root}/out"))
    kinds = td.state_events(events).count()
    assert 0 < snap.agg(F.sum("late_events")).first()[0] < kinds


def test_settled_state_is_bounded_and_equal():
    """Settling with an advancing watermark changes no snapshot when events come within the delay."""
    rnd = random.Random(4)
    rows, day = [], us.DAY_US
    for i in range(900):
        kind = rnd.choices(["interaction", "like_toggle", "cart_toggle", "preferences", "reset"], [60, 15, 15, 8, 1])[0]
        ts = i * day // 20 + rnd.randrange(day // 30)
        rows.append((kind, ts, i, rnd.randrange(12), "view", str(ts // day), 1, 2, rnd.randrange(4)))
    names = ["kind", "ts_us", "event_id", "product_id", "interaction_type", "session_id", "c1", "c2", "n_categories"]
    whole = us.settle(us.apply_events(us._empty_state(), pd.DataFrame(rows, columns=names)))
    st, top = us._empty_state(), 0
    for a in range(0, len(rows), 30):
        part = rows[a:a + 30]
        rnd.shuffle(part)
        mark = max(0, top - 2 * day)
        us.settle(us.apply_events(st, pd.DataFrame(part, columns=names), mark), mark)
        top = max(top, *(r[1] for r in part))
    assert us.snapshot_row(1, st) == us.snapshot_row(1, whole)
    assert len(st["keys"]) < 120 and len(st["final"]) <= 2 * us.C.HISTORY_CAP and st["late"] == 0


def test_csv_log_stream_equals_batch_history(spark):
    """The reference's own log has no event ids: batch feed and stream agree on made ones."""
    folder = tempfile.mkdtemp(prefix="csv-log-", dir="/tmp")
    lines = ["user_id,product_id,interaction_type,interaction_score,rating,review_sentiment,timestamp,session_id"]
    rnd = random.Random(3)
    for i in range(400):
        day = rnd.randrange(1, 9)
        lines.append(f"{rnd.randrange(4)},{rnd.choice([rnd.randrange(30), ''])},{rnd.choice(['view', 'click'])},1,,,2024-03-0{day} 0{rnd.randrange(10)}:0{rnd.randrange(3)}:00,s{day}")
    for i in range(2):
        with open(f"{folder}/log-{i}.csv", "w") as f:
            f.write("\n".join([lines[0], *lines[1 + i::2]]) + "\n")
    log = clean.with_event_ids(clean.clean_interactions(files.read_interactions(spark, folder)))
    want = feed.recent_interactions(log)
    root = runner.run_root(spark, "csv-test")
    runner.run_available(us.user_state_stream(files.state_events(files.read_interactions_stream(spark, folder, 1))), root)
    got = us.history_rows(us.latest_snapshots(spark.read.parquet(f"{root}/out")))
    cols = ["user_id", "event_id", "product_id", "interaction_type", "recency_rank"]
    assert want.count() > 100 and same_rows(got.select(cols), want.select(cols))


def test_hook_runs_the_state_function_once(spark):
    """The hook reads the written rows: however often it uses them, each user's function runs once."""
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(len(b))
            yield b
    stream = td.state_events(runner.events_stream(spark, SF001, "events.parquet"))
    snaps = us.user_state_stream(stream).mapInPandas(count, us.SNAPSHOT_SCHEMA)
    seen = []
    runner.run_available(snaps, runner.run_root(spark, "once"), lambda df, i: seen.extend([df.count(), df.count(), df.count()]))
    assert calls.value == seen[0] == seen[2]


def test_streams_do_not_depend_on_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")     # half-hour offset
        got = R.q_stream_hourly_sessions(spark, SF01)
        want = R.q_hourly_sessions(spark, SF01)
        assert same_rows(got, want)
        assert same_rows(R.q_stream_recent_interactions(spark, SF01), R.history(spark, SF01))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
