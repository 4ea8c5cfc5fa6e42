"""Previous row of the same key in a given order, robust to hot keys.

``lag(x) over (partition by key order by ...)`` puts every row of a key in
one task: when one sender holds a third of all rows, one task holds a
third of the data. Here each key is split into buckets of a monotonic
function of the order (a time range, an offset range). The window runs per
(key, bucket), so a hot key spreads over as many tasks as it has buckets,
and the first row of each bucket takes its predecessor from a carry table:
the last value of the key's previous non-empty bucket.

Plan: one map-side-combined aggregate to the carry table (one row per
key-bucket), a window over that small table per key, and one shuffle of
the rows on (key, bucket) shared by the carry join and the window.
Null keys never have a predecessor; their bucket is a hash of the order
columns so they never pile up in one task.

A fixed time range may still hold most of a key's rows. :func:`hot_slices` counts the rows of
each (key, range) and cuts the ranges of more than ``target`` rows at quantiles of
their own times, so that pieces follow the rows and not the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.session import materialize

NULL_KEY_SPREAD = 1 << 16
#: Rows of a (key, time range) above which it is cut, and room for its pieces' numbers.
HOT_ROWS = 1_000_000
PIECES = 1 << 20


def hot_slices(df: DataFrame, key: str, micros: Column, width_us: int, target: int = HOT_ROWS) -> DataFrame | None:
    """``(_key, _slice, _cuts)``: the times at which the slices (``width_us`` wide) of more than
    ``target`` rows of a key are cut, into pieces of about ``target`` rows or less; ``None`` if there are
    none. For stored rows: counts them at once. There is at most one slice for each ``target`` rows of
    the table, and only their number of pieces reaches the driver. Rows of a key at
    one same time stay together."""
    rows = (df.select(F.col(key).alias("_key"), micros.alias("_us")).where("_key IS NOT NULL AND _us IS NOT NULL")
            .withColumn("_slice", F.floor(F.col("_us") / F.lit(width_us))))
    hot = materialize(rows.groupBy("_key", "_slice").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target), "hot-slices")
    most = hot.agg(F.max("_n")).first()[0]
    if most is None:
        return None
    pieces = min(PIECES - 1, -(-int(most) // target))
    quantiles = F.percentile_approx("_us", [k / pieces for k in range(1, pieces)], 100 * pieces)
    return materialize(rows.join(hot.drop("_n"), ["_key", "_slice"]).groupBy("_key", "_slice").agg(quantiles.alias("_cuts")), "hot-cuts")


def sliced(df: DataFrame, key: str, micros: Column, width_us: int, hot: DataFrame | None = None) -> tuple[DataFrame, Column]:
    """``df`` and the bucket of its rows for :func:`previous_value`: the slice of their time or, with
    ``hot`` (:func:`hot_slices`), the piece of it. It doesn't decrease with the time."""
    number = F.floor(micros / F.lit(width_us))
    if hot is None:
        return df, number
    cuts = hot.select(F.col("_key").alias("_hot_key"), F.col("_slice").alias("_hot_slice"), "_cuts")
    df = df.join(cuts, (F.col(key) == F.col("_hot_key")) & (number == F.col("_hot_slice")), "left").drop("_hot_key", "_hot_slice")
    return df, number * PIECES + F.coalesce(F.size(F.filter("_cuts", lambda c: c <= micros)), F.lit(0))


def previous_value(df: DataFrame, key: str, order: list[str], value: str, out: str,
                   bucket: Column) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row with the same ``key`` in
    ``order`` (null for the first row of a key, and for null keys).

    ``bucket`` must be a non-decreasing function of ``order`` (for example
    the day of a timestamp).
    """
    k = F.col(key)
    b = F.when(k.isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(NULL_KEY_SPREAD))) \
        .otherwise(bucket).cast("long")
    rows = df.withColumn("_b", b)

    # value of the last row of each (key, bucket); fixed-width buffers keep it
    # a hash aggregate in the common cases
    if value == order[0]:
        last = F.struct(F.max(value).alias("_v"))
    elif len(order) == 1:
        last = F.struct(F.max_by(value, order[0]).alias("_v"))
    else:
        last = F.max(F.struct(*[F.col(c) for c in order], F.col(value).alias("_v")))
    carry = (rows.where(k.isNotNull()).groupBy(key, "_b").agg(last.alias("_last"))
             .select(key, "_b", F.lag("_last").over(Window.partitionBy(key).orderBy("_b")).alias("_carry"))
             .where(F.col("_carry").isNotNull()))

    w = Window.partitionBy(key, "_b").orderBy(*[F.col(c) for c in order])
    within = F.lag(F.struct(F.col(value).alias("_v"))).over(w)
    prev = F.when(within.isNotNull(), within["_v"]).otherwise(F.col("_carry._v"))
    return (rows.join(carry, [key, "_b"], "left")
            .withColumn(out, F.when(k.isNotNull(), prev))
            .drop("_b", "_carry"))
