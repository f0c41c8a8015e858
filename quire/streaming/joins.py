"""Two streams joined in time, and sessions, with watermarks that bound their state; late rows are counted, not silent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def within(left: DataFrame, right: DataFrame, keys: dict[str, str], times: tuple[str, str], before: str, after: str, late: tuple[str, str], how: str = "inner") -> DataFrame:
    """Pairs of rows of two streams with equal keys, the right one from ``before`` ahead of the left one's time to ``after`` behind it.

    Names of both sides have to differ. Each side has a watermark (``late``), and the bounds let Spark drop a row from the state once no
    partner can come any more; with ``how="leftOuter"`` a left row without a partner comes out then.
    """
    a, b = left.withWatermark(times[0], late[0]), right.withWatermark(times[1], late[1])
    on = F.col(times[1]).between(F.col(times[0]) - F.expr(f"INTERVAL {before}"), F.col(times[0]) + F.expr(f"INTERVAL {after}"))
    for x, y in keys.items():
        on = on & (F.col(x) == F.col(y))
    return a.join(b, on, how)


def sessions(rows: DataFrame, keys: tuple[str, ...], time: str, gap: str, late: str, *aggregates: Column) -> DataFrame:
    """keys, session_start, session_end and the aggregates of each session: rows of a key with less than ``gap`` from one to the next.

    A session comes out once the watermark has passed its end (its last row and the gap).
    """
    timed = rows.withWatermark(time, late) if rows.isStreaming else rows
    groups = timed.groupBy(*keys, F.session_window(time, gap)).agg(*aggregates)
    return groups.select(*keys, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *[c for c in groups.columns if c not in (*keys, "session_window")])


def late_rows(query: StreamingQuery) -> int:
    """The rows that a query's operators have dropped because they came behind the watermark."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
