"""High-value and rapid-succession flags, and an exact distributed quantile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.functions.calendar import epoch_micros, gap_seconds
from paylake.operators.sequence import HOT_ROWS, hot_slices, previous_value, sliced
from paylake.schemas import HIGH_VALUE_QUANTILE, RAPID_GAP_SECONDS

# Order-preserving coarse bucket: 5 significant digits per decade. The number
# of buckets is bounded by the value domain (90,000 per decade, about a million for
# amounts of 12 digits), not by the row count, and so is the one-task running sum over
# them; a bucket of such amounts holds ten million different cents at most.
_DECADE_OFFSET = 400
_DIGITS = 5
# A sender's rows of so many seconds make one piece of work.
SPLIT_SECONDS = 3600


def _coarse_bucket(v: Column) -> Column:
    a = F.abs(v)
    e = F.floor(F.log10(a))
    m = F.floor(a / F.pow(F.lit(10.0), e - (_DIGITS - 1)))
    mag = (e + _DECADE_OFFSET) * 10 ** _DIGITS + m
    return F.when(v == 0, F.lit(0)).when(v > 0, mag).otherwise(-mag).cast("long")


def exact_quantile(df: DataFrame, col: str, q: float, name: str = "threshold") -> DataFrame:
    """One-row DataFrame with the exact ``q`` quantile of ``col`` (linear
    interpolation between closest ranks, as pandas / ``quantile_cont``).

    Distributed plan; no task ever holds all distinct values:
      1. histogram ``value -> count`` (map-side combined);
      2. coarse histogram over order-preserving buckets (bounded size by
         construction) with running counts and the total in one window ->
         the one or two buckets holding ranks ``floor(r)`` and ``ceil(r)``,
         ``r = (n - 1) * q``;
      3. running counts inside those buckets only -> the two values;
      4. ``lo + (hi - lo) * (r - floor(r))`` in double.
    Empty input gives a null quantile.
    """
    v = F.col(col).cast("double")
    hist = (df.where(F.col(col).isNotNull()).groupBy(v.alias("v"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("b", _coarse_bucket(F.col("v"))))
    covers = lambda p: (F.col("start") <= F.col(p)) & (F.col(p) < F.col("start") + F.col("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    r = ((F.sum("n").over(Window.partitionBy()) - 1).cast("double") * F.lit(float(q)))
    coarse = (hist.groupBy("b").agg(F.sum("n").alias("n"))
              .select("b", "n", before(Window.orderBy("b")).alias("start"), r.alias("r"))
              .withColumn("lo", F.floor("r")).withColumn("hi", F.ceil("r")))
    # at most two rows: broadcasting them is bounded
    buckets = coarse.where(covers("lo") | covers("hi")).select("b", F.col("start").alias("bstart"), "lo", "hi", "r")
    fine = (hist.join(F.broadcast(buckets), "b")
            .withColumn("start", F.col("bstart") + before(Window.partitionBy("b").orderBy("v"))))
    picked = fine.agg(
        F.max(F.when(covers("lo"), F.col("v"))).alias("vlo"),
        F.max(F.when(covers("hi"), F.col("v"))).alias("vhi"),
        F.max("r").alias("r"), F.max("lo").alias("lo"))
    val = F.col("vlo") + (F.col("vhi") - F.col("vlo")) * (F.col("r") - F.col("lo"))
    # a global aggregate always yields one row, even for an empty input
    return picked.select(val.alias(name))


def flag_high_value(df: DataFrame, q: float = HIGH_VALUE_QUANTILE, col: str = "amount") -> DataFrame:
    """``is_high_value = amount >= quantile(amount, q)`` over this batch.

    The threshold is a scalar subquery: computed once, before the main
    stage, and used as a value in every task (no join). A query that does
    not use ``is_high_value`` has the whole quantile plan pruned away.
    """
    th = exact_quantile(df, col, q, "_threshold").scalar()
    flag = F.coalesce(F.col(col).cast("double") >= th, F.lit(False))
    return df.withColumn("is_high_value", flag)


def hot_hours(df: DataFrame, split_seconds: int = SPLIT_SECONDS, target: int = HOT_ROWS) -> DataFrame | None:
    """The hours of single senders that hold more than ``target`` of the (stored) rows, for
    :func:`flag_rapid_succession`."""
    return hot_slices(df, "sender_msisdn", epoch_micros(F.col("timestamp")), split_seconds * 1_000_000, target)


def flag_rapid_succession(df: DataFrame, gap: float = RAPID_GAP_SECONDS,
                          split_seconds: int = SPLIT_SECONDS, hot: DataFrame | None = None) -> DataFrame:
    """Seconds since the same sender's previous transaction and the flag
    ``gap < 120 s``. Order: (timestamp, transaction_id). Null senders never
    have a predecessor (never rapid). Each sender's rows are split into
    ``split_seconds`` time ranges so a hot sender spreads over many tasks, and those in ``hot``
    (:func:`hot_hours`) further by their rows (see :mod:`paylake.operators.sequence`)."""
    rows, bucket = sliced(df, "sender_msisdn", epoch_micros(F.col("timestamp")), split_seconds * 1_000_000, hot)
    out = previous_value(rows, "sender_msisdn", ["timestamp", "transaction_id"], "timestamp",
                         "_prev_ts", bucket).drop("_cuts")
    secs = gap_seconds(F.col("_prev_ts"), F.col("timestamp"))
    return (out.withColumn("time_since_last_txn_sec", secs)
            .withColumn("is_rapid_succession", F.coalesce(F.col("time_since_last_txn_sec") < gap, F.lit(False)))
            .drop("_prev_ts"))


def quantile_frame(df: DataFrame, q: float = HIGH_VALUE_QUANTILE, col: str = "amount") -> DataFrame:
    return exact_quantile(df, col, q, "p95_amount")
