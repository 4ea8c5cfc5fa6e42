"""Validation, first-copy de-duplication and the reject funnel.

Plan shape: null ids are left out before anything moves; the earliest copy of each
id is the first row of a window over the id in ``ingest_seq`` order. The
filter on the row number lets the optimizer drop later copies on the map side
too, so an id repeated a billion times costs one row per map task in the
shuffle. Only the columns that a query uses are shuffled.

A run that may store intermediate results takes two phases instead: ids and input numbers
alone are aggregated into the list of ids that occur more than once (hash aggregates,
map-side minima), and the wide rows meet the stored list in an outer join. With its size
known, a small list is broadcast, and the rows are neither shuffled nor sorted; a large one makes a
shuffled join that AQE may split at hot ids. Everything after it (parsing, reject reasons)
is a narrow projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.functions.parse import parse_decimal, parse_timestamp
from paylake.functions.text import strip
from paylake.schemas import FEE_TYPE

KEY = "transaction_id"
SEQ = "ingest_seq"

# Reject reasons, in the order the rules apply (first failure is charged).
DUPLICATE_OR_NULL = "duplicate_or_null_ids"
INVALID_TIMESTAMP = "invalid_timestamps"
INVALID_AMOUNT = "invalid_amounts"
NON_POSITIVE = "non_positive_amounts"
ISSUE_KEYS = [DUPLICATE_OR_NULL, INVALID_TIMESTAMP, INVALID_AMOUNT]
CLEAN = "clean"


def repeated_ids(raw: DataFrame, key: str = KEY, seq: str = SEQ) -> DataFrame:
    """``(_id, _first)``: the non-null ids of more than one row, and the input number of the first."""
    return (raw.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id"))
            .agg(F.min(seq).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))


def dedup_first(raw: DataFrame, key: str = KEY, seq: str = SEQ, repeated: DataFrame | None = None) -> DataFrame:
    """Rows with a non-null key, first copy in input order wins (raw columns). Input numbers
    are unique. ``repeated``: the stored :func:`repeated_ids` of ``raw``, for the plan of two phases."""
    rows = raw.where(F.col(key).isNotNull())
    if repeated is None:
        copies = Window.partitionBy(key).orderBy(seq)
        return rows.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")
    rows = rows.join(repeated, F.col(key) == F.col("_id"), "left")
    return rows.where(F.col("_first").isNull() | (F.col(seq) == F.col("_first"))).drop("_id", "_first")


def classify(raw: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The de-duplicated rows with typed columns and their reject reason.

    ``timestamp`` -> timestamp_ntz, ``amount`` -> decimal(12,2), ``fee`` ->
    decimal(18,2), 0 where the text is no number. ``reject_reason`` is null for a
    clean row, else the first rule that fails. An amount's sign is that of its
    text, before rounding to cents. A fee that is a number but too large for its
    type is an invalid amount; it never turns into another value silently.
    """
    fee = parse_decimal(F.col("fee"), *FEE_TYPE)
    wide = strip(F.col("fee")).try_cast("double")
    too_large = fee.isNull() & wide.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))
    exact = strip(F.col("amount")).try_cast("decimal(38,18)")
    df = dedup_first(raw, repeated=repeated)
    df = df.select(
        *[c for c in df.columns if c not in ("timestamp", "amount", "fee")],
        parse_timestamp(F.col("timestamp")).alias("timestamp"), parse_decimal(F.col("amount"), 12, 2).alias("amount"),
        F.coalesce(fee, F.lit(0).cast(f"decimal({FEE_TYPE[0]},{FEE_TYPE[1]})")).alias("fee"),
        too_large.alias("_fee_too_large"), (exact <= 0).alias("_not_positive"))
    reason = (F.when(F.col("timestamp").isNull(), F.lit(INVALID_TIMESTAMP))
              .when(F.col("amount").isNull() | F.coalesce("_fee_too_large", F.lit(False)), F.lit(INVALID_AMOUNT))
              .when(F.col("_not_positive"), F.lit(NON_POSITIVE)))
    return df.withColumn("reject_reason", reason).drop("_fee_too_large", "_not_positive")


def clean_rows(classified: DataFrame) -> DataFrame:
    """Rows that pass every rule, with typed columns."""
    return classified.where(F.col("reject_reason").isNull()).drop("reject_reason")


def reject_funnel(raw: DataFrame, classified: DataFrame) -> DataFrame:
    """``(reject_reason, rows)``: rows charged to each rule, clean rows as
    ``clean``. Sums to the raw row count: what de-duplication took away (null ids
    and extra copies) is the raw count less the classified rows."""
    kept = (classified.groupBy(F.coalesce("reject_reason", F.lit(CLEAN)).alias("reason")).agg(F.count(F.lit(1)).alias("n")))
    total = raw.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("string").alias("reason"), "n")
    parts = kept.unionByName(total).select(F.explode(F.array(
        F.struct("reason", "n"),
        F.struct(F.lit(DUPLICATE_OR_NULL).alias("reason"), F.when(F.col("reason").isNull(), F.col("n")).otherwise(-F.col("n")).alias("n")),
    )).alias("p"))
    return (parts.where(F.col("p.reason").isNotNull()).groupBy(F.col("p.reason").alias("reject_reason"))
            .agg(F.sum("p.n").cast("long").alias("rows")))


__all__ = ["repeated_ids", "dedup_first", "classify", "clean_rows", "reject_funnel", "ISSUE_KEYS"]
