"""State variables and timers against the batch operators, in any order of events."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shelfrank.plans import registry as R
from shelfrank.sources import testdata as td
from shelfrank.streaming import keyed_state as ks
from shelfrank.streaming import runner
from shelfrank.streaming import user_state as us
from test_streaming import doubled, same_rows, split_files


@pytest.mark.parametrize("order,chunk", [("newest", 20), ("random", 10_000)])
def test_snapshots_equal_batch(spark, monkeypatch, order, chunk):
    events = doubled(spark.read.parquet(f"{SF001}/events.parquet"))
    flat = split_files(spark, events, 3, order)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(chunk))
    try:
        root = runner.run_root(spark, "keyed-order")
        runner.run_available(ks.user_state_stream(td.list_events(runner.events_stream(spark, flat, "events-*.parquet", 1))), root, state_store=ks.PROVIDER)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    snap = us.latest_snapshots(spark.read.parquet(f"{root}/out"))
    monkeypatch.setattr(td, "_read", lambda s, d, name: events if name == "events" else s.read.parquet(f"{d}/{name}.parquet"))
    c = R.Ctx(spark, SF001)
    assert same_rows(us.history_rows(snap), R.q_toggle_history(spark, SF001))
    assert same_rows(us.list_rows(snap, "wishlist"), c.wishlist)
    assert same_rows(us.list_rows(snap, "cart"), c.cart)
    assert same_rows(R.joined(ks.preference_rows(snap), "categories"), R.q_latest_preference_lists(spark, SF001))
    assert snap.agg(F.sum("late_events")).first()[0] == 0


class Variable(dict):
    """A map or value state that counts what is written."""
    written = 0

    def getValue(self, key):
        return self.get_(key)

    def get_(self, key):
        return dict.get(self, key)

    def updateValue(self, key, value):
        self[key] = value
        Variable.written += len(value[0])

    def removeKey(self, key):
        del self[key]

    def iterator(self):
        return iter(list(self.items()))

    def exists(self):
        return () in self

    def get(self, *key):
        return dict.get(self, ())

    def update(self, value):
        self.updateValue((), value)


class Clock:
    def __init__(self, us_):
        self.ms = us_ // 1000

    def getCurrentWatermarkInMs(self):
        return self.ms


def processor():
    p = ks.UserState()
    timers = set()
    p.handle = type("Handle", (), {"registerTimer": lambda self, ms: timers.add(ms)})()
    p.sessions, p.lists, p.info = Variable(), Variable(), Variable()
    return p, timers


def feed(p, rows, watermark=0):
    part = pd.DataFrame([dict(zip(ks.COLUMNS, r)) for r in rows], columns=ks.COLUMNS)
    return next(p.handleInputRows((1,), iter([part]), Clock(watermark))).iloc[0].to_dict()


def test_writes_follow_the_events_not_the_state():
    p, _ = processor()
    day = ks.DAY_US
    many = [("interaction", i * 1000, i, i, "view", f"s{i % 50}", None) for i in range(3000)] + [("like_toggle", i, 5000 + i, i, None, None, None) for i in range(500)]
    Variable.written = 0
    feed(p, many)
    first = Variable.written
    Variable.written = 0
    snap = feed(p, [("interaction", 60_000_000, 9000, 3, "view", "new", None), ("like_toggle", day, 9001, 3, None, None, None)])
    assert Variable.written < first / 100
    assert len(snap["history"]) == us.C.HISTORY_CAP and len(snap["wishlist"]) == 499


def test_timers_settle_without_changing_what_is_shown():
    import random
    rnd = random.Random(8)
    rows = []
    for i in range(700):
        kind = rnd.choices(["interaction", "like_toggle", "cart_toggle", "preferences", "reset"], [60, 20, 15, 8, 1])[0]
        ts = i * ks.DAY_US // 20 + rnd.randrange(ks.DAY_US // 30)
        rows.append((kind, ts, i, rnd.randrange(12), rnd.choice(["view", "purchase"]), str(ts // ks.DAY_US), ["a", None, "b", "c"][:rnd.randrange(5)]))
    whole, _ = processor()
    want = feed(whole, rows)
    p, timers = processor()
    top = 0
    for at in range(0, len(rows), 35):
        part = rows[at:at + 35]
        rnd.shuffle(part)
        mark = max(0, top - 2 * ks.DAY_US)
        due = {t for t in timers if t * 1000 <= mark}
        timers -= due
        for _ in due:
            list(p.handleExpiredTimer((1,), Clock(mark), None))
        got = feed(p, part, mark)
        top = max(top, *(r[1] for r in part))
    assert got == want and got["late_events"] == 0
    assert sum(len(json.loads(v[0])) for v in p.sessions.values()) < 120
    late = feed(p, [("interaction", 0, 10_000, 1, "view", "0", None)], 10 * ks.DAY_US)
    assert late["late_events"] == 1 and late["history"] == got["history"]


def test_odd_rows():
    p, _ = processor()
    snap = feed(p, [("interaction", 5, 1, None, "view", None, None), ("interaction", 5, 2, 7, None, None, None), ("preferences", 6, 3, None, None, None, None),
                    ("preferences", 6, 4, None, None, None, ["x", None]), ("like_toggle", 7, 5, float("nan"), None, None, None)])
    assert [h["product_id"] for h in snap["history"]] == [7] and snap["pref_event_id"] is None and snap["wishlist"] == []
