"""The first-seen processor against a state that counts its questions."""

import datetime

from pyspark.sql import Row
from pyspark.sql.types import StructType

from quire.streaming.first_seen import FirstOfKey


class Handle:
    """State, timers and a count of all calls on them, each a round trip in Spark."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def __getattr__(self, name):
        ways = {"getValueState": lambda *_: self, "get": lambda: self.value, "exists": lambda: self.value is not None, "update": lambda v: setattr(self, "value", v), "clear": lambda: setattr(self, "value", None),
                "listTimers": lambda: iter([(t,) for t in self.timers]), "registerTimer": self.timers.add, "deleteTimer": self.timers.remove}

        def call(*args):
            self.calls += 1
            return ways[name](*args)

        return call


def test_round_trips_and_timers():
    at = lambda s: datetime.datetime.fromtimestamp(s, datetime.UTC)
    p, h = FirstOfKey(StructType().add("k", "string").add("o", "long").add("at", "timestamp"), ("o",), "at", 10_000), Handle()
    p.init(h)
    h.calls = 0
    give = lambda *rows: list(p.handleInputRows(("a",), iter([Row(k="a", o=o, at=at(s)) for o, s in rows]), None))
    give((5, 100), (7, 99))
    assert h.calls == 3 and h.timers == {109_000}
    give((6, 120))  # neither smaller nor earlier: one question
    assert h.calls == 4 and h.timers == {109_000}
    give((9, 90))  # earlier, not smaller
    assert h.timers == {100_000}
    give((1, 130))  # smaller, not earlier
    assert h.timers == {100_000}
    h.calls = 0
    assert [(r["k"], r["o"], r["at"]) for r in p.handleExpiredTimer(("a",), None, None)] == [("a", 1, at(130))] and h.calls == 2 and h.value is None
