"""Streams that keep batch results current (ST6, ST7, ST8).

* ``popularity_streams`` (ST8): clean interactions (deduplicated within the watermark) summed per
  product, and distinct users per product, both of the same clean stream. Each batch hands over the
  products that it touched and no others; ``PopularRefresher`` merges them into the popular lists (A8 + W1). Which
  duplicate the dedup keeps does not matter here: all copies of a key have one type, so one score.
* ``run_hourly`` (ST6): one-hour windows per user. Here it does matter which copy counts, and the earliest may
  come last: the dedup keeps the earliest (ts, event_id) of each key as state and, when a better copy comes, takes the old
  one back (-1 in its window, +1 in the new one). A second keyed sum applies these changes.
* ``FeedRefresher`` (ST7): a ``foreachBatch`` hook that recomputes the personal feed of the users a
  batch touched, from their streamed state and the static similar / complementary / popular lists.

Their input are the typed state events of ``user_state``. Rows behind the watermark are dropped by the
stateful operators; the runner notes their number. The hooks keep nothing in memory: every table is
written to a folder of its own version, and readers take the last one that is complete.
"""

from __future__ import annotations

import json
import threading
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfrank.functions.columns import interaction_weight, ntz_from_micros, session_key
from shelfrank.operators import catalog, feed
from shelfrank.streaming import runner
from shelfrank.streaming.user_state import LATENESS, history_rows

DEDUP_KEY = ["user_id", "product_id", "interaction_type", "session_id"]
HOUR_US = 3_600_000_000


def _interactions(events: DataFrame, watermark: str) -> DataFrame:
    se = events.filter((F.col("kind") == "interaction") & F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
    return se.withWatermark("ts", watermark)


def clean_interaction_stream(events: DataFrame, watermark: str = LATENESS) -> DataFrame:
    """The interactions with their score (P17; an unknown type has none), one of each dedup key."""
    scored = _interactions(events, watermark).withColumn("interaction_score", interaction_weight())
    return scored.dropDuplicatesWithinWatermark(DEDUP_KEY)


def popularity_streams(events: DataFrame, watermark: str = LATENESS) -> tuple[DataFrame, DataFrame]:
    """Two product-level streaming aggregations (run in update mode) over the same clean stream:

    * scores: per product the summed score and count of the clean interactions;
    * users: per product the number of distinct users (first occurrences of (product, user)).

    State: one row per product, the clean-dedup keys within the watermark, and the (product, user) pairs
    seen. The pairs are what an exact distinct count needs: they are at most the non-zero cells of the
    user-product matrix, spread over the state partitions. Each batch hands over the rows of the products that it touched."""
    clean = clean_interaction_stream(events, watermark)
    scores = clean.groupBy("product_id").agg(F.sum("interaction_score").cast("bigint").alias("popularity_score"),
                                             F.count("*").alias("total_interactions"))
    pairs = clean.select("product_id", "user_id").dropDuplicates(["product_id", "user_id"])
    users = pairs.groupBy("product_id").agg(F.count("*").alias("unique_users"))
    return scores, users


def approximate_popularity_stream(events: DataFrame, watermark: str = LATENESS) -> DataFrame:
    """The option with bounded state: one aggregation for both, with an HLL sketch of the users in place of the (product, user) pairs, so
    state is one row of some KB at most for each product. unique_users is an estimate; ``popularity_streams`` stays the exact form."""
    return catalog.estimated_users(catalog.popularity_sketches(clean_interaction_stream(events, watermark)))


def current(spark: SparkSession, path: str, column: str = "version") -> DataFrame | None:
    """The rows of the highest ``column=N`` folder below ``path``, or None if there is none. A folder shows
    rows only once its write has been committed, so a version that is being written is not read."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException:
        return None
    last = rows.agg(F.max(column)).first()[0]
    return None if last is None else rows.filter(F.col(column) == last).drop(column)


def last_version(spark: SparkSession, path: str, column: str = "version") -> int | None:
    """The highest ``column=N`` below ``path``, or None."""
    try:
        return spark.read.parquet(path).agg(F.max(column)).first()[0]
    except AnalysisException:
        return None


class Totals:
    """The latest row of each product from batches that hold the touched products only.

    ``<path>/rows/batch_id=N`` has the rows of batch N, and every ``every`` batches the latest rows of all
    products go to ``<path>/base/upto=N``; a reader takes the last base and the batches after it."""

    def __init__(self, spark: SparkSession, path: str, schema: str, every: int = 64):
        self.spark, self.path, self.schema, self.every = spark, path, schema, every

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Store a batch (a repeated one replaces itself), and return its rows as stored."""
        path = f"{self.path}/rows/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        if batch_id % self.every == self.every - 1:
            self.latest().write.mode("overwrite").parquet(f"{self.path}/base/upto={batch_id}")
        return self.spark.read.schema(self.schema).parquet(path)

    def latest(self) -> DataFrame:
        upto = last_version(self.spark, f"{self.path}/base", "upto")
        names = [c.split()[0] for c in self.schema.split(", ")]
        rows = self.spark.createDataFrame([], f"{self.schema}, batch_id long")
        try:
            batches = self.spark.read.parquet(f"{self.path}/rows").select(*names, F.col("batch_id").cast("long").alias("batch_id"))
            rows = batches if upto is None else batches.filter(F.col("batch_id") > upto)
        except AnalysisException:
            pass
        if upto is not None:
            base = self.spark.read.parquet(f"{self.path}/base").filter(F.col("upto") == upto)
            rows = rows.unionByName(base.select(*names, F.col("upto").cast("long").alias("batch_id")))
        last = F.max_by(F.struct(*names), "batch_id").alias("r")
        return rows.groupBy("product_id").agg(last).select("r.*")


class PopularRefresher:
    """foreachBatch hooks of the two popularity streams. A hook stores the rows of the products that the batch touched
    and merges them into the lists: the new top of a category is among its listed products and the touched ones,
    unless a listed product has fallen below its own score; only then is its category ranked anew from all
    totals. Each change is a new version of the lists; after a restart everything is found again in the folders."""

    def __init__(self, spark: SparkSession, products: DataFrame, root: str):
        self.spark, self.products, self.root = spark, products, root
        self.totals = {"scores": Totals(spark, f"{root}/scores", "product_id long, popularity_score long, total_interactions long"),
                       "users": Totals(spark, f"{root}/users", "product_id long, unique_users long")}
        # Both streams call back on the driver, each from its own thread; one at a time merges into the lists.
        self.lock = threading.Lock()

    def hook(self, name: str):
        def write(batch_df: DataFrame, batch_id: int) -> None:
            with self.lock:
                self.merge(self.totals[name].write(batch_df, batch_id).select("product_id"))
        return write

    def hook_both(self, batch_df: DataFrame, batch_id: int) -> None:
        """For a stream that has all columns, as ``approximate_popularity_stream``."""
        with self.lock:
            batch_df = batch_df.persist()
            self.totals["users"].write(batch_df.select("product_id", "unique_users"), batch_id)
            rows = self.totals["scores"].write(batch_df.select("product_id", "popularity_score", "total_interactions"), batch_id)
            batch_df.unpersist()
            self.merge(rows.select("product_id"))

    def merge(self, touched: DataFrame) -> None:
        path = f"{self.root}/popular"
        last = last_version(self.spark, path)
        scores = self.totals["scores"].latest()
        if last is not None:
            listed = self.spark.read.parquet(path).filter(F.col("version") == last)
            before = listed.select("product_id", "category", F.col("popularity_score").alias("before"))
            fallen = scores.join(before, "product_id").filter(F.coalesce("popularity_score", F.lit(0)) < F.coalesce("before", F.lit(0)))
            again = self.products.join(fallen.select("category").distinct(), "category", "left_semi").select("product_id")
            asked = listed.select("product_id").union(touched).union(again).distinct()
            scores = scores.join(asked, "product_id", "left_semi")
        users = self.totals["users"].latest()
        popularity = scores.join(users, "product_id", "left").fillna(0, subset=["unique_users"])
        popular = catalog.rank_popular(popularity.select("product_id", "popularity_score", "total_interactions", "unique_users"), self.products)
        popular.write.mode("overwrite").parquet(f"{path}/version={0 if last is None else last + 1}")


CHANGES = "user_id long, window_us long, delta long"


def _delay_ms(watermark: str) -> int:
    return int(pd.Timedelta(watermark).total_seconds() * 1000)


def _first_copies(watermark: str):
    """State of a user: for each session the earliest (ts, event_id) of each product and type. A session goes once the watermark has
    passed its last event by the delay: copies that come later than that count again, as in the stateful dedup. The key is the user and
    not the session: a call of Python costs far more than an event, and most sessions are an event or two."""
    def update(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        sessions = json.loads(state.get[0]) if state.exists else {}
        touched = set()
        changes: Counter = Counter()
        for rows in () if state.hasTimedOut else chunks:
            for session, product, kind, ts, event in zip(*(rows[c].tolist() for c in ("session_id", "product_id", "interaction_type", "ts_us", "event_id"))):
                name, place, new = "" if session is None else f"s{session}", f"{int(product)}|{kind}", [int(ts), int(event)]
                held = sessions.setdefault(name, [{}, 0, 0])   # firsts, time of the last event, end of the session's state
                old = held[0].get(place)
                if old is None or new < old:
                    held[0][place] = new
                    changes[new[0] // HOUR_US] += 1
                    if old is not None:
                        changes[old[0] // HOUR_US] -= 1
                held[1] = max(held[1], new[0])
                touched.add(name)
        for name in touched:
            sessions[name][2] = max(sessions[name][1] // 1000, now) + _delay_ms(watermark) + 1
        sessions = {name: held for name, held in sessions.items() if name in touched or held[2] >= now}
        if sessions:
            state.update((json.dumps(sessions),))
            state.setTimeoutTimestamp(min(held[2] for held in sessions.values()))
        else:
            state.remove()
        out = [(key[0], hour * HOUR_US, n) for hour, n in changes.items() if n]
        yield pd.DataFrame(out, columns=["user_id", "window_us", "delta"])
    return update


def window_changes(events: DataFrame, watermark: str = LATENESS) -> DataFrame:
    """Changes (+1, -1) of the hourly windows of each user, from a dedup that takes back what an earlier copy replaces."""
    rows = _interactions(events, watermark).select("ts", "user_id", "session_id", "product_id", "interaction_type", "ts_us", "event_id")
    return rows.groupBy("user_id").applyInPandasWithState(_first_copies(watermark), CHANGES, "blob string", "append", GroupStateTimeout.EventTimeTimeout)


def window_counts(changes: DataFrame, watermark: str = LATENESS) -> DataFrame:
    """ST6: events per user and one-hour window, with the hour's session key, from a stream of changes. No change lies further
    back than the delay of its own watermark and an hour, so none is late here. Update mode emits changed windows."""
    delay = f"{_delay_ms(watermark) // 1000 + 7200} seconds"
    w = changes.withColumn("w", F.timestamp_micros("window_us")).withWatermark("w", delay)
    g = w.groupBy("user_id", "w", "window_us").agg(F.sum("delta").alias("n_events"))
    start = ntz_from_micros(F.col("window_us"))
    return g.select("user_id", start.alias("window_start"), "n_events", session_key("user_id", start).alias("hour_session_id"))


def run_hourly(events: DataFrame, root: str, watermark: str = LATENESS) -> DataFrame:
    """Both steps over the events available now, and the windows. The changes go through a file sink, whose log of committed
    batches lets the second query read each exactly once, also after a restart."""
    runner.run_to_files(window_changes(events, watermark), root, "changes")
    changes = events.sparkSession.readStream.schema(CHANGES).parquet(f"{root}/changes")
    runner.run_available(window_counts(changes, watermark), f"{root}/windows")
    return latest_windows(events.sparkSession.read.parquet(f"{root}/windows/out"))


def latest_windows(rows: DataFrame) -> DataFrame:
    """The last row of each window; windows that have lost all their events are none."""
    return (rows.groupBy("user_id", "window_start")
            .agg(F.max_by(F.struct("n_events", "hour_session_id"), "batch_id").alias("r"))
            .select("user_id", "window_start", "r.*").filter("n_events > 0"))


class FeedRefresher:
    """ST7 foreachBatch hook: the personal feeds of the users touched by a batch of state snapshots.

    ``now`` is the latest interaction time seen so far; each batch stores it, so a restart goes on from
    it. The feed rows are written with the batch id; ``latest_feed`` keeps each user's newest batch.
    """

    def __init__(self, spark: SparkSession, products: DataFrame, similar: DataFrame, complementary: DataFrame,
                 popular: DataFrame, users: DataFrame, feed_path: str):
        self.spark, self.products, self.users, self.feed_path = spark, products, users, feed_path
        self.similar, self.complementary, self.popular = similar, complementary, popular

    def __call__(self, snaps: DataFrame, batch_id: int) -> None:
        before = current(self.spark, f"{self.feed_path}-now")
        known = snaps.select(F.max("max_interaction_ts_us").alias("now_us"))
        if before is not None:
            known = known.union(before.select("now_us"))
        now_us = known.agg(F.max("now_us")).first()[0]
        if now_us is None:
            return
        self.spark.createDataFrame([(now_us,)], "now_us long").write.mode("overwrite").parquet(f"{self.feed_path}-now/version={batch_id}")
        now = ntz_from_micros(F.lit(now_us))
        hist = history_rows(snaps)
        slots = feed.feed_slots(feed.time_decay_weights(hist, now))
        prefs = feed.name_categories(snaps.filter(F.col("pref_event_id").isNotNull())
                                     .select("user_id", F.col("pref_event_id").alias("event_id"), "c1", "c2",
                                             "n_categories"), self.products)
        touched = self.users.join(snaps.select("user_id"), "user_id", "left_semi")
        cats = feed.user_categories(touched, prefs, self.products)
        out = feed.personal_feed(slots, self.similar, self.complementary, self.products, cats, self.popular)
        out.write.mode("overwrite").parquet(f"{self.feed_path}/batch_id={batch_id}")     # idempotent per batch


def latest_feed(feed_rows: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Each user's feed from the user's last snapshot batch (no rows if that feed was empty)."""
    last = snapshots.groupBy("user_id").agg(F.max("batch_id").alias("batch_id"))
    return feed_rows.join(last, ["user_id", "batch_id"]).select("user_id", "position", "product_id")
