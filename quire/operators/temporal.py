"""Joins by time: the last row before each row (as-of), and intervals that overlap.

As-of: both sides in one table, sorted once by key and time; the last right row so far is carried down to each left row. A
key with many rows (``hot_parts``, ``least_hot``) is cut into slices of time, so that no task sorts it whole: slices are sorted each for
itself, and what is carried into a slice comes from the last rows of the slices before, a row a slice. Other keys are one slice.
So the rows cross one shuffle, whatever their keys.

Overlaps: a row of length l belongs to the class of the least power of two that is at least l; at that width it lies in two bins at most.
Two rows that overlap share a bin at the width of the longer one. So each row is laid into the bins of its own class, to be met,
and into those of every greater class that the other side has, to meet; the pair is taken in the bin where the later of the two
begins, so once. The join is on keys, class and bin: an equality, not a comparison of all with all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A key is cut if it has over one row in HOT_PARTS and over LEAST_HOT, which one task sorts without notice; into SLICES.
HOT_PARTS, SLICES, LEAST_HOT = 1000, 64, 100_000


def asof(left: DataFrame, right: DataFrame, keys: dict[str, str], times: tuple[str, str], values: tuple[str, ...], ties: tuple[str, ...] = (), tolerance_us: int | None = None, hot_parts: int = HOT_PARTS, slices: int = SLICES, least_hot: int = LEAST_HOT) -> DataFrame:
    """The left rows with ``values`` of the last right row of their key whose time is not after theirs; null if there is none.

    ``keys`` maps left columns to right columns. Of right rows with one key and time the last by ``ties`` counts. With ``tolerance_us`` an older
    row does not count. Left rows without a key or a time stay, with nulls; such right rows match nothing.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    lost = F.lit(False)
    for c in (*keys, times[0]):
        lost = lost | F.col(c).isNull()
    whole = F.struct(*left.columns)
    mine = left.where(~lost).select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)], F.unix_micros(F.col(times[0]).cast("timestamp")).alias("_t"), F.lit(1).alias("_side"), whole.alias("_left"))
    kept = F.struct(F.unix_micros(F.col(times[1]).cast("timestamp")).alias("_t"), F.struct(*ties).alias("ties") if ties else F.lit(0).alias("ties"), F.struct(*values).alias("v"))
    theirs = right.select(*[F.col(c).alias(n) for c, n in zip(keys.values(), names, strict=True)], F.unix_micros(F.col(times[1]).cast("timestamp")).alias("_t"), F.lit(0).alias("_side"), kept.alias("_right")).where("_t is not null").dropna(subset=names)
    rows = mine.unionByName(theirs, allowMissingColumns=True)

    # Keys with many rows, hot_parts of them at most.
    counts = rows.groupBy(*names).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") > max(total / hot_parts, least_hot))
    sliced = not hot.isEmpty()
    if sliced:  # where their time is cut
        cuts = rows.join(F.broadcast(hot.select(*names)), names, "left_semi").groupBy(*names).agg(F.percentile_approx("_t", [i / slices for i in range(1, slices)], 10_000).alias("_cuts"))
        slice_ = F.size(F.filter("_cuts", lambda c: c < F.col("_t")))
        rows = rows.join(F.broadcast(cuts), names, "left").withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(slice_)).drop("_cuts")
    by = [*names, *["_slice"] * sliced]
    own = Window.partitionBy(*by).orderBy("_t", "_side", F.col("_right.ties")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("_last", F.last("_right", ignorenulls=True).over(own)).where("_side = 1")
    found = F.col("_last")
    if sliced:  # the last right row of each slice of a hot key, carried over the slices after it: slices rows a key
        ends = rows.where("_side = 0").join(F.broadcast(hot.select(*names)), names, "left_semi").groupBy(*by).agg(F.max(F.struct("_right._t", "_right.ties", "_right.v")).alias("_end"))
        every = hot.select(*names, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice")).join(ends, by, "left")
        before = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        edges = every.select(*by, F.last("_end", ignorenulls=True).over(before).alias("_edge"))
        out = out.join(F.broadcast(edges), by, "left")
        found = F.coalesce("_last", "_edge")
    if tolerance_us is not None:
        found = F.when(F.col("_t") - found["_t"] <= tolerance_us, found)
    matched = out.select("_left.*", *[found["v"][v].alias(v) for v in values])
    none = left.where(lost).select("*", *[F.lit(None).cast(right.schema[v].dataType).alias(v) for v in values])
    return matched.unionByName(none)


def _class(length: F.Column) -> F.Column:
    """The exponent of the least power of two that is at least the length: the digits of length - 1 in base two."""
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int")


def _bin(at: F.Column, class_: F.Column) -> F.Column:
    """floor(at / 2 ** class), for negative numbers too."""
    return F.call_function("shiftright", at, class_)


def overlaps(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str], keys: dict[str, str] | None = None) -> DataFrame:
    """Pairs of rows whose intervals [start, end) share a point, each once: the columns of both sides, whose names have to differ.

    Bounds are whole numbers (microseconds, say). Rows with a null bound or key (no equality holds for it), and empty intervals, are in no pair. ``keys`` maps left
    columns to right columns that have to be equal. The classes of each side, 64 at most, are counted first.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    keys = keys or {}

    def laid(df: DataFrame, bounds: tuple[str, str], cols: list[str], side: str) -> DataFrame:
        lo, hi = (F.col(b).cast("long") for b in bounds)
        out = df.select(F.struct(*df.columns).alias(f"_{side}"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], lo.alias("_lo"), hi.alias("_hi")).where("_lo < _hi")
        return out.withColumn("_class", _class(F.col("_hi") - F.col("_lo")))

    a, b = laid(left, left_bounds, list(keys), "a"), laid(right, right_bounds, list(keys.values()), "b")
    held = {side: [r[0] for r in df.select("_class").distinct().collect()] for side, df in (("a", a), ("b", b))}  # 64 classes at most
    names = [f"_k{i}" for i in range(len(keys))]

    def bins(df: DataFrame, classes: F.Column, side: str) -> DataFrame:
        """A row for each of the classes and each bin of that width it lies in, two at most."""
        each = df.withColumn("_at", F.explode(classes))
        each = each.withColumn("_bin", F.explode(F.sequence(_bin(F.col("_lo"), F.col("_at")), _bin(F.col("_hi") - 1, F.col("_at")))))
        return each.select(*names, "_at", "_bin", F.col("_lo").alias(f"_{side}_lo"), F.col("_hi").alias(f"_{side}_hi"), f"_{side}")

    def from_(side: str, least: F.Column) -> F.Column:
        return F.filter(F.array(*map(F.lit, sorted(held[side]))).cast("array<int>"), lambda c: c >= least)

    # The longer row is met in bins of its own class; where classes are equal that is the left one.
    own, class_ = F.array("_class"), F.col("_class")
    one = bins(a, own, "a").join(bins(b, from_("a", class_), "b"), [*names, "_at", "_bin"])
    two = bins(b, own, "b").join(bins(a, from_("b", class_ + 1), "a"), [*names, "_at", "_bin"])
    both = one.unionByName(two)
    later = F.greatest("_a_lo", "_b_lo")
    met = both.where((later < F.least("_a_hi", "_b_hi")) & (_bin(later, F.col("_at")) == F.col("_bin")))
    return met.select("_a.*", "_b.*")
