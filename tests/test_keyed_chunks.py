"""Chunks of the keyed state: few calls for a user, and one timer that is set again."""

from pyspark.sql import functions as F

from conftest import SF001
from shelfrank.plans import registry as R
from shelfrank.sources import testdata as td
from shelfrank.streaming import keyed_state as ks
from shelfrank.streaming import runner
from shelfrank.streaming import user_state as us
from test_keyed_state import Variable, feed, processor
from test_streaming import same_rows, split_files


def test_calls_do_not_follow_the_events(monkeypatch):
    calls = []
    update = Variable.updateValue
    monkeypatch.setattr(Variable, "updateValue", lambda self, key, value: (calls.append(key), update(self, key, value)))
    p, timers = processor()
    rows = [("interaction", i * ks.DAY_US // 7, i, i % 9, "view", f"s{i // 7}", None) for i in range(300)] + [("cart_toggle", i, 1000 + i, i, None, None, None) for i in range(90)]
    want = feed(p, rows)
    assert len(calls) == 3 and len(timers) == 1
    p, _ = processor()
    for at in range(0, len(rows), 5):
        got = feed(p, rows[at:at + 5])
        assert max(len(p.sessions), len(p.lists)) <= ks.MOST_CHUNKS
    assert got == want


def test_timers_in_a_stream(spark):
    """Events in order with a short delay: days end while the stream runs."""
    events = spark.read.parquet(f"{SF001}/events.parquet")
    flat = split_files(spark, events, 5, "oldest")
    root = runner.run_root(spark, "keyed-timers")
    runner.run_available(ks.user_state_stream(td.list_events(runner.events_stream(spark, flat, "events-*.parquet", 1)), "1 day"), root, state_store=ks.PROVIDER)
    snap = us.latest_snapshots(spark.read.parquet(f"{root}/out"))
    assert snap.agg(F.sum("late_events")).first()[0] == 0
    assert same_rows(us.history_rows(snap), R.q_toggle_history(spark, SF001))
    assert same_rows(us.list_rows(snap, "cart"), R.Ctx(spark, SF001).cart)
