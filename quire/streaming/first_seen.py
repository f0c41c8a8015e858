"""First of each key on a stream, by an order of its own and not by arrival; state ends with the delay."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType


class FirstOfKey(StatefulProcessor):
    """Holds the smallest row of a key by ``order`` until the watermark has passed the time of the key's earliest row and the delay, then gives it out."""

    def __init__(self, schema: StructType, order: tuple[str, ...], time: str, delay_ms: int):
        self.schema, self.order, self.time, self.delay_ms = schema, order, time, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", StructType([*self.schema.fields, StructField("_due", LongType())]))

    def _place(self, row) -> tuple:
        """Nulls come first, as in Spark's own order."""
        return tuple((row[c] is not None, row[c]) if row[c] is not None else (False,) for c in self.order)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.best.get()  # one question a key: the row and, last, when its timer is due
        best = Row(**dict(zip(self.schema.names, held, strict=False))) if held is not None else None
        was, before, earliest = None if held is None else held[-1], best, None
        for row in rows:
            at = int(row[self.time].timestamp() * 1000)
            earliest = at if earliest is None else min(earliest, at)
            if best is None or self._place(row) < self._place(best):
                best = row
        due = earliest + self.delay_ms
        if was is None or due < was:
            if was is not None:
                self.handle.deleteTimer(was)
            self.handle.registerTimer(due)
        else:
            due = was
        if best is not before or due != was:
            self.best.update((*(best[c] for c in self.schema.names), due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        best = self.best.get()
        if best is not None:
            self.best.clear()
            yield Row(**dict(zip(self.schema.names, best, strict=False)))

    def close(self) -> None:
        pass


def first_seen(rows: DataFrame, key: str, order: tuple[str, ...], time: str, delay_ms: int, late: str = "0 seconds") -> DataFrame:
    """One row a key: the smallest by ``order`` of those within ``delay_ms`` of the key's earliest, in whatever order files arrive.

    A row comes out once the watermark (the latest ``time`` less ``late``) has passed its key's earliest time and the delay; the key's
    state and timer go then. Rows behind the watermark are dropped as late by Spark. Rows without a key or a time are left out.
    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    good = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late)
    return good.groupBy(key).transformWithState(FirstOfKey(rows.schema, order, time, delay_ms), rows.schema, "Append", "EventTime")


#: The state store that timers need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
