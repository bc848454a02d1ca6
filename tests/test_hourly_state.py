"""The state of the hourly stream's dedup: one record for each user, sessions that end one by one."""

import json

import pandas as pd

from shelfrank.streaming import refresh

HOUR = refresh.HOUR_US


class State:
    """A group state without Spark."""
    blob = timeout = None
    mark, hasTimedOut = 0, False
    exists = property(lambda self: self.blob is not None)
    get = property(lambda self: self.blob)

    def getCurrentWatermarkMs(self):
        return self.mark

    def update(self, value):
        self.blob = value

    def remove(self):
        self.blob = self.timeout = None

    def setTimeoutTimestamp(self, ms):
        assert ms >= self.mark
        self.timeout = ms


def feed(state, *rows):
    part = pd.DataFrame(rows, columns=["session_id", "product_id", "interaction_type", "ts_us", "event_id"])
    out = pd.concat(refresh._first_copies("1 hour")((7,), iter([part]), state))
    return {w // HOUR: n for w, n in zip(out["window_us"], out["delta"])}


def test_sessions_of_a_user_are_apart_and_end_apart():
    s = State()
    assert feed(s, ("a", 1, "view", 5 * HOUR, 10), ("b", 1, "view", 5 * HOUR, 11), ("a", 1, "view", 5 * HOUR + 1, 12), (None, 1, "view", 9 * HOUR, 13)) == {5: 2, 9: 1}
    assert s.timeout == 6 * 3_600_000 + 1
    assert feed(s, ("b", 1, "view", 4 * HOUR, 3)) == {5: -1, 4: 1}                     # an earlier copy replaces a later one
    s.mark = 6 * 3_600_000 + 2                                                       # the delay after both sessions
    assert feed(s, ("b", 1, "view", 7 * HOUR, 20), (None, 1, "view", 9 * HOUR, 14)) == {}  # touched in time: goes on
    assert len(json.loads(s.blob[0])) == 2 and s.timeout == 8 * 3_600_000 + 1           # the first one has gone
    assert feed(s, ("a", 1, "view", 8 * HOUR, 30)) == {8: 1}
    s.mark, s.hasTimedOut = 20 * 3_600_000, True
    assert feed(s) == {} and not s.exists
