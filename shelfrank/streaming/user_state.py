"""User state as a Structured Streaming job (ST1-ST5), one ``applyInPandasWithState`` keyed by user.

Its input are typed state events: (event_id, user_id, ts, ts_us, kind, product_id, interaction_type,
session_id, c1, c2, n_categories). ``sources.testdata.state_events`` makes them from the driver's events,
``sources.files.state_events`` from the interaction log. The state of a user is a set of facts that can be merged
in any order, so snapshots depend neither on the order of events within and across batches nor on the
Arrow chunk size:

* interaction -- per (product, type, session) the earliest (ts, event_id), as the batch cleaning keeps it;
  the history is the newest ``HISTORY_CAP`` of them;
* like_toggle / cart_toggle -- the toggles of a product; it is in the list if their number is odd;
* preferences -- the updates that no other one beats both in (ts, event_id) and in event_id;
* reset -- the greatest reset event id: a tombstone for every event up to it, also for events that come
  after it (the dedup keys stay, as the batch cleaning runs before the reset filter).

How late an event may come is the watermark delay, ``LATENESS`` by default. An event behind the watermark
is not applied but counted in ``late_events`` of the user's snapshot; nothing else is ever dropped. Facts
that no admissible event can change any more are cut to what can still show: the newest ``HISTORY_CAP``
of the history (more only if event ids and times disagree), and one count for each toggled product. So
state per user is bounded by what happened within the delay, and the current lists.

After each batch the touched users' snapshots are emitted (update mode); the final snapshots equal the
batch operators' results on the same events, in any order (tests check this).
"""

from __future__ import annotations

import bisect
import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from shelfrank.functions import constants as C
from shelfrank.functions.columns import ntz_from_micros

#: How far an event may lie behind the latest one seen.
LATENESS = "60 days"

SNAPSHOT_SCHEMA = (
    "user_id long, reset_event_id long, "
    "history array<struct<event_id:long,product_id:long,interaction_type:string,ts_us:long>>, "
    "wishlist array<struct<product_id:long,added_event_id:long,added_ts_us:long>>, "
    "cart array<struct<product_id:long,added_event_id:long,added_ts_us:long>>, "
    "pref_event_id long, c1 long, c2 long, n_categories long, max_interaction_ts_us long, late_events long"
)
STATE_SCHEMA = "blob string"
DAY_US = 86_400_000_000


def _empty_state() -> dict:
    return {"keys": {}, "final": [], "wish": {}, "cart": {}, "prefs": [], "reset": None, "max_ts": None, "late": 0}


def _beaten(entries: list, times: int) -> list:
    """Entries [ts, event_id, ...] without those that at least ``times`` others beat both in
    (ts, event_id) and in event_id: no later reset can make such an entry one of the ``times`` newest."""
    kept, ids = [], []
    for e in sorted(entries, key=lambda e: (e[0], e[1]), reverse=True):
        if len(ids) - bisect.bisect_right(ids, e[1]) < times:
            kept.append(e)
        bisect.insort(ids, e[1])
    return kept[::-1]


def apply_events(st: dict, events: pd.DataFrame, watermark_us: int = 0,
                 min_categories: int = C.MIN_PREFERRED_CATEGORIES) -> dict:
    """Merge one user's events, in any order and any number of parts, into its state; also used by tests.
    Call ``settle`` once all parts of a batch are in."""
    names = ["kind", "ts_us", "event_id", "product_id", "interaction_type", "session_id", "c1", "c2", "n_categories"]
    for kind, ts, eid, pid, itype, session, c1, c2, n in zip(*(events[c].tolist() for c in names)):
        ts, eid = int(ts), int(eid)
        if ts < watermark_us:
            st["late"] += 1
        elif kind == "preferences":
            if n >= min_categories:
                st["prefs"] = _beaten([p for p in st["prefs"] if p[1] != eid] + [[ts, eid, int(c1), int(c2), int(n)]], 1)
        elif kind == "reset":
            st["reset"] = eid if st["reset"] is None else max(st["reset"], eid)
        elif pid is None or pd.isna(pid):
            continue
        elif kind == "interaction":
            key = f"{int(pid)}|{itype}|{session}"
            known = st["keys"].get(key)
            if known is None or (ts, eid) < (known[0], known[1]):
                st["keys"][key] = [ts, eid, int(pid), itype]
            st["max_ts"] = ts if st["max_ts"] is None else max(st["max_ts"], ts)
        else:
            st["wish" if kind == "like_toggle" else "cart"].setdefault(str(int(pid)), {"old": None, "new": []})["new"].append([ts, eid])
    return st


def settle(st: dict, watermark_us: int = 0, cap: int = C.HISTORY_CAP) -> dict:
    """Cut what no admissible event can change: keys of sessions (days) that ended before the watermark,
    toggles and updates before it, and whatever a reset has cleared."""
    reset = -1 if st["reset"] is None else st["reset"]
    ended = [k for k, v in st["keys"].items() if (v[0] // DAY_US + 1) * DAY_US <= watermark_us]
    st["final"] = _beaten([v for v in [*st["final"], *(st["keys"].pop(k) for k in ended)] if v[1] > reset], cap)
    for name in ("wish", "cart"):
        for pid, t in list(st[name].items()):
            if t["old"] and t["old"][3] <= reset:
                t["old"] = None
            t["new"] = [x for x in t["new"] if x[1] > reset]
            for ts, eid in [x for x in t["new"] if x[0] < watermark_us]:
                n, last_ts, last_eid, top = t["old"] or [0, -1, -1, -1]
                t["old"] = [n + 1, *max((last_ts, last_eid), (ts, eid)), max(top, eid)]
            t["new"] = [x for x in t["new"] if x[0] >= watermark_us]
            if not t["old"] and not t["new"]:
                del st[name][pid]
    st["prefs"] = [p for p in st["prefs"] if p[1] > reset]
    return st


def snapshot_row(user_id: int, st: dict, cap: int = C.HISTORY_CAP) -> dict:
    reset = -1 if st["reset"] is None else st["reset"]

    def lst(toggles):
        items = []
        for pid, t in toggles.items():
            n, ts, eid, _ = t["old"] or [0, -1, -1, -1]
            if (n + len(t["new"])) % 2:
                items.append((*max([(ts, eid), *map(tuple, t["new"])]), int(pid)))
        return [{"product_id": p, "added_event_id": e, "added_ts_us": ts} for ts, e, p in sorted(items)]

    history = sorted(v for v in [*st["final"], *st["keys"].values()] if v[1] > reset)[-cap:]
    pref = max(st["prefs"], default=[None] * 5)
    return {
        "user_id": int(user_id), "reset_event_id": st["reset"],
        "history": [{"event_id": e, "product_id": p, "interaction_type": t, "ts_us": ts} for ts, e, p, t in history],
        "wishlist": lst(st["wish"]), "cart": lst(st["cart"]),
        "pref_event_id": pref[1], "c1": pref[2], "c2": pref[3], "n_categories": pref[4],
        "max_interaction_ts_us": st["max_ts"], "late_events": st["late"],
    }


def _update(key, chunks, state):
    st = json.loads(state.get[0]) if state.exists else _empty_state()
    watermark_us = state.getCurrentWatermarkMs() * 1000
    for pdf in chunks:
        apply_events(st, pdf, watermark_us)
    settle(st, watermark_us)
    state.update((json.dumps(st),))
    yield pd.DataFrame([snapshot_row(key[0], st)])


def user_state_stream(events: DataFrame, watermark: str = LATENESS) -> DataFrame:
    """Snapshots of the touched users' state from a stream of typed state events (the columns of
    the module's text), one row per user and batch."""
    cols = ["user_id", "event_id", "ts_us", "kind", "product_id", "interaction_type", "session_id", "c1", "c2", "n_categories"]
    return (events.withWatermark("ts", watermark).select("ts", *cols).groupBy("user_id")
            .applyInPandasWithState(_update, SNAPSHOT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout))


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The last snapshot per user from appended (batch_id, snapshot) rows."""
    return (snapshots.groupBy("user_id").agg(F.max_by(F.struct(*[c for c in snapshots.columns if c != "batch_id"]),
                                                      "batch_id").alias("s"))
            .select("s.*"))


def history_rows(snap: DataFrame) -> DataFrame:
    """ST1 as rows: (user_id, event_id, product_id, interaction_type, ts, recency_rank)."""
    h = snap.select("user_id", F.posexplode("history").alias("i", "h"), F.size("history").alias("n"))
    return h.select("user_id", F.col("h.event_id").alias("event_id"), F.col("h.product_id").alias("product_id"),
                    F.col("h.interaction_type").alias("interaction_type"),
                    ntz_from_micros(F.col("h.ts_us")).alias("ts"),
                    (F.col("n") - F.col("i")).cast("int").alias("recency_rank"))


def list_rows(snap: DataFrame, column: str) -> DataFrame:
    """ST2/ST3 as rows: (user_id, product_id, added_event_id, added_ts, position)."""
    x = snap.select("user_id", F.posexplode(column).alias("i", "x"))
    return x.select("user_id", F.col("x.product_id").alias("product_id"),
                    F.col("x.added_event_id").alias("added_event_id"),
                    ntz_from_micros(F.col("x.added_ts_us")).alias("added_ts"),
                    (F.col("i") + 1).cast("int").alias("position"))
