"""User state in keyed state variables (ST1-ST5, W7 with additions): a ``transformWithStateInPandas`` processor.

It keeps the facts of ``user_state`` (see there why their order does not matter), but not as one text per user that every
batch writes anew. A user has

* ``sessions``: per session the earliest (ts, event_id) of each product and type, in chunks;
* ``lists``: per product and list the toggles within the delay, and what is settled before, in chunks;
* ``info``: the reset, the undominated preference updates, and the settled history (some ``HISTORY_CAP`` events).

A batch reads the chunks, which its snapshot needs anyway, and writes one more chunk with the facts of its events: facts merge in any
order. Each call of a state variable is a round trip to the JVM, so a user costs a batch a few calls and not some for each event. A
timer at the end of the earliest open day, in event time, settles what no admissible event can change and leaves one chunk; a batch that
finds ``MOST_CHUNKS`` does the same. So what a batch writes follows its events and not the state.

Two things are new against ``user_state``: toggles that add a product are events of the history (``like``, ``add_to_cart``), as the
batch operator ``state.with_additions`` has them, and preference updates hold category lists.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shelfrank.functions import constants as C
from shelfrank.streaming.user_state import DAY_US, LATENESS, _beaten

SNAPSHOT_SCHEMA = (
    "user_id long, reset_event_id long, "
    "history array<struct<event_id:long,product_id:long,interaction_type:string,ts_us:long>>, "
    "wishlist array<struct<product_id:long,added_event_id:long,added_ts_us:long>>, "
    "cart array<struct<product_id:long,added_event_id:long,added_ts_us:long>>, "
    "pref_event_id long, categories array<string>, max_interaction_ts_us long, late_events long"
)
#: The history event that an addition to a list makes.
ADDITIONS = {"like_toggle": "like", "cart_toggle": "add_to_cart"}
COLUMNS = ["kind", "ts_us", "event_id", "product_id", "interaction_type", "session_id", "categories"]
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _added(item: str, toggles: dict, reset: int) -> list[list]:
    """The additions among the toggles of a list item that are not settled: every other one, counted from the last reset."""
    kind, product = item.split("|")
    before = toggles["old"][0] if toggles["old"] else 0
    live = sorted(t for t in toggles["new"] if t[1] > reset)
    return [[ts, event, int(product), ADDITIONS[kind]] for i, (ts, event) in enumerate(live) if (before + i) % 2 == 0]


#: Chunks of a user's sessions and list items above which a batch merges them.
MOST_CHUNKS = 32


def _merge_sessions(into: dict, more: dict) -> dict:
    for session, firsts in more.items():
        held = into.setdefault(session, {})
        for place, first in firsts.items():
            if place not in held or first[:2] < held[place][:2]:
                held[place] = first
    return into


def _merge_lists(into: dict, more: dict) -> dict:
    for item, toggles in more.items():
        held = into.setdefault(item, {"old": None, "new": []})
        held["old"] = held["old"] or toggles["old"]    # one chunk at most holds what is settled
        held["new"] = held["new"] + toggles["new"]
    return into


class UserState(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", "chunk string", "blob string")
        self.lists = handle.getMapState("lists", "chunk string", "blob string")
        self.info = handle.getValueState("info", "blob string")

    def _info(self) -> tuple[dict, bool]:
        if self.info.exists():
            return json.loads(self.info.get()[0]), True
        return {"reset": None, "prefs": [], "final": [], "max_ts": None, "late": 0, "chunk": 0, "chunks": 0, "timer": None}, False

    def _held(self) -> tuple[dict, dict]:
        """All chunks of the sessions and of the list items, merged."""
        sessions, items = {}, {}
        for _, (blob,) in self.sessions.iterator():
            _merge_sessions(sessions, json.loads(blob))
        for _, (blob,) in self.lists.iterator():
            _merge_lists(items, json.loads(blob))
        return sessions, items

    def _add(self, info: dict, sessions: dict, items: dict, replace: bool) -> None:
        """Write one more chunk, or one in place of all others."""
        if replace:
            for state in (self.sessions, self.lists):
                for name in [name for (name,), _ in state.iterator()]:
                    state.removeKey((name,))
            info["chunks"] = 0
        info["chunk"] += 1
        info["chunks"] += 1
        for state, rows in ((self.sessions, sessions), (self.lists, items)):
            if rows:
                state.updateValue((str(info["chunk"]),), (json.dumps(rows),))

    def _wake(self, info: dict, times: set[int], watermark_us: int) -> None:
        """One timer: the end of the earliest day among ``times`` (the old one still fires if it is later, and finds nothing)."""
        end = min(((ts // DAY_US + 1) * DAY_US // 1000 for ts in times), default=None)
        held = info["timer"] if info["timer"] is not None and info["timer"] * 1000 > watermark_us else None
        if end is not None and (held is None or end < held):
            self.handle.registerTimer(end)
            held = end
        info["timer"] = held

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        info, known = self._info()
        sessions: dict[str, dict] = {}
        items: dict[str, dict] = {}
        times: set[int] = set()
        for part in rows:
            for kind, ts, event, product, itype, session, categories in zip(*(part[c].tolist() for c in COLUMNS)):
                ts, event = int(ts), int(event)
                if ts < watermark_us:
                    info["late"] += 1
                elif kind == "preferences":
                    chosen = [c for c in (categories if categories is not None else []) if c is not None]
                    if len(chosen) >= C.MIN_PREFERRED_CATEGORIES:
                        info["prefs"] = _beaten([p for p in info["prefs"] if p[1] != event] + [[ts, event, chosen]], 1)
                elif kind == "reset":
                    info["reset"] = event if info["reset"] is None else max(info["reset"], event)
                elif product is None or pd.isna(product):
                    continue
                elif kind == "interaction":
                    _merge_sessions(sessions, {str(session): {f"{int(product)}|{itype}": [ts, event, int(product), itype]}})
                    info["max_ts"] = ts if info["max_ts"] is None else max(info["max_ts"], ts)
                    times.add(ts)
                else:
                    items.setdefault(f"{kind}|{int(product)}", {"old": None, "new": []})["new"].append([ts, event])
                    times.add(ts)
        shown = (sessions, items)
        if known:
            held_sessions, held_items = self._held()
            shown = (_merge_sessions(held_sessions, sessions), _merge_lists(held_items, items))
        if sessions or items:
            replace = info["chunks"] >= MOST_CHUNKS
            self._add(info, *(shown if replace else (sessions, items)), replace)
        self._wake(info, times, watermark_us)
        self.info.update((json.dumps(info),))
        yield pd.DataFrame([self._snapshot(key[0], info, *shown)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Settle the days that have ended: their sessions and toggles can't change any more. Emits nothing, as nothing that a
        snapshot shows changes."""
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        info, _ = self._info()
        reset = -1 if info["reset"] is None else info["reset"]
        sessions, items = self._held()
        final = list(info["final"])
        left_sessions, left_items, times = {}, {}, set()
        for name, firsts in sessions.items():
            ended = {p: v for p, v in firsts.items() if (v[0] // DAY_US + 1) * DAY_US <= watermark_us}
            final += ended.values()
            left = {p: v for p, v in firsts.items() if p not in ended}
            if left:
                left_sessions[name] = left
                times.update(v[0] for v in left.values())
        for name, toggles in items.items():
            if any(ts < watermark_us for ts, _ in toggles["new"]):
                if toggles["old"] and toggles["old"][3] <= reset:
                    toggles["old"] = None
                final += [a for a in _added(name, toggles, reset) if a[0] < watermark_us]
                live = [t for t in toggles["new"] if t[1] > reset]
                for ts, event in [t for t in live if t[0] < watermark_us]:
                    n, last_ts, last_event, top = toggles["old"] or [0, -1, -1, -1]
                    toggles["old"] = [n + 1, *max((last_ts, last_event), (ts, event)), max(top, event)]
                toggles["new"] = [t for t in live if t[0] >= watermark_us]
            if toggles["old"] or toggles["new"]:
                left_items[name] = toggles
                times.update(ts for ts, _ in toggles["new"])
        self._add(info, left_sessions, left_items, True)
        self._wake(info, times, watermark_us)
        info["final"] = _beaten([v for v in final if v[1] > reset], C.HISTORY_CAP)
        info["prefs"] = [p for p in info["prefs"] if p[1] > reset]
        self.info.update((json.dumps(info),))
        yield pd.DataFrame()

    def _snapshot(self, user, info: dict, sessions: dict, items: dict) -> dict:
        reset = -1 if info["reset"] is None else info["reset"]
        lists: dict[str, list] = {kind: [] for kind in ADDITIONS}
        events = [v for v in info["final"] if v[1] > reset] + [v for firsts in sessions.values() for v in firsts.values() if v[1] > reset]
        for name, toggles in items.items():
            kind, product = name.split("|")
            if toggles["old"] and toggles["old"][3] <= reset:
                toggles = {"old": None, "new": toggles["new"]}
            events += _added(name, toggles, reset)
            live = [tuple(t) for t in toggles["new"] if t[1] > reset]
            n, ts, event, _ = toggles["old"] or [0, -1, -1, -1]
            if (n + len(live)) % 2:
                lists[kind].append((*max([(ts, event), *live]), int(product)))
        history = sorted(events, key=lambda v: (v[0], v[1]))[-C.HISTORY_CAP:]
        pref = max((p for p in info["prefs"] if p[1] > reset), key=lambda p: (p[0], p[1]), default=[None, None, None])
        shown = {kind: [{"product_id": p, "added_event_id": e, "added_ts_us": ts} for ts, e, p in sorted(rows)] for kind, rows in lists.items()}
        return {"user_id": None if pd.isna(user) else int(user), "reset_event_id": info["reset"],
                "history": [{"event_id": e, "product_id": p, "interaction_type": t, "ts_us": ts} for ts, e, p, t in history],
                "wishlist": shown["like_toggle"], "cart": shown["cart_toggle"], "pref_event_id": pref[1], "categories": pref[2],
                "max_interaction_ts_us": info["max_ts"], "late_events": info["late"]}

    def close(self) -> None:
        pass


def user_state_stream(events: DataFrame, watermark: str = LATENESS) -> DataFrame:
    """Snapshots of the touched users' state from a stream of typed state events (the columns of ``user_state``, with
    ``categories array<string>`` for c1, c2 and n_categories), one row per user and batch. State variables need the RocksDB
    state store: run it with ``state_store=PROVIDER``."""
    rows = events.withWatermark("ts", watermark).select("ts", "user_id", *COLUMNS)
    return rows.groupBy("user_id").transformWithStateInPandas(UserState(), SNAPSHOT_SCHEMA, "Update", "EventTime")


def preference_rows(snapshots: DataFrame) -> DataFrame:
    """ST4 as rows: (user_id, event_id, categories) of the users with a valid update."""
    return snapshots.filter(F.col("pref_event_id").isNotNull()).select("user_id", F.col("pref_event_id").alias("event_id"), "categories")
