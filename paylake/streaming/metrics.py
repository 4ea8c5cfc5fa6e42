"""Running metrics over live events: totals, keyed sums, and a snapshot.

Batch twins are plain aggregates; the streaming versions are the same
aggregates on a streaming frame (complete mode: O(1) state for totals,
key-domain-bounded state for the keyed sums). Money is summed as
decimal(12,2) so totals are exact and order-independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.numeric import half_up_ratio


def _amount():
    return F.col("amount_ghs").cast("decimal(12,2)")


def _fee():
    return F.col("fee_ghs").cast("decimal(12,2)")


def metrics_totals(events: DataFrame) -> DataFrame:
    """One row of running totals."""
    return events.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.coalesce(F.sum(_amount()), F.lit(0)).cast("double").alias("total_volume_ghs"),
        F.coalesce(F.sum(_fee()), F.lit(0)).cast("double").alias("total_fees_ghs"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.coalesce(F.col("is_high_value"), F.lit(False))).alias("high_value_count"),
    )


def keyed_sums(events: DataFrame) -> DataFrame:
    """Exact running sums per (dimension, key) for operator, region and type,
    in one aggregation (each event contributes one row to each dimension):
    volume and fees as decimals, transactions, successful, failed and
    high-value counts. The operator dimension alone adds up to the totals."""
    dims = F.explode(F.array(
        F.struct(F.lit("operator").alias("dimension"), F.col("operator").alias("key")),
        F.struct(F.lit("region").alias("dimension"), F.col("region").alias("key")),
        F.struct(F.lit("type").alias("dimension"), F.col("transaction_type").alias("key")),
    )).alias("d")
    return (events.select(dims, _amount().alias("amt"), _fee().alias("fee"), "status", "is_high_value")
            .groupBy(F.col("d.dimension").alias("dimension"), F.col("d.key").alias("key"))
            .agg(F.sum("amt").alias("volume"), F.sum("fee").alias("fees"),
                 F.count(F.lit(1)).alias("transactions"),
                 F.count_if(F.col("status") == "SUCCESS").alias("successful"),
                 F.count_if(F.col("status") == "FAILED").alias("failed"),
                 F.count_if(F.coalesce(F.col("is_high_value"), F.lit(False))).alias("high_value_count")))


def metrics_by_key(events: DataFrame) -> DataFrame:
    """``(dimension, key, volume_ghs, transactions)`` for operator, region and type."""
    return keyed_sums(events).select("dimension", "key", F.col("volume").cast("double").alias("volume_ghs"),
                                     "transactions")


def snapshot_from(keyed: DataFrame) -> DataFrame:
    """One snapshot row from :func:`keyed_sums`, in a single aggregation over
    its few rows (no join, no subquery).

    Totals come from the operator dimension. Top operator/region: largest
    volume, smallest name on ties, ``N/A`` when nothing was seen. Success
    rate is a one-decimal percentage, 0 when empty.
    """
    dim, key = F.col("dimension"), F.col("key")

    def total(c, dtype="long"):
        return F.coalesce(F.sum(F.when(dim == "operator", F.col(c))), F.lit(0)).cast(dtype)

    def top(d):
        return F.min_by(key, F.when((dim == d) & key.isNotNull(), F.struct(-F.col("volume"), key)))

    agg = keyed.agg(
        total("transactions").alias("total_transactions"),
        total("volume", "double").alias("total_volume_ghs"),
        total("fees", "double").alias("total_fees_ghs"),
        total("successful").alias("successful"),
        total("high_value_count").alias("high_value_count"),
        top("operator").alias("top_operator"), top("region").alias("top_region"))
    n = F.col("total_transactions")
    return agg.select(
        "total_transactions",
        F.round("total_volume_ghs", 2).alias("total_volume_ghs"),
        F.round("total_fees_ghs", 2).alias("total_fees_ghs"),
        F.coalesce(half_up_ratio(F.col("successful"), F.greatest(n, F.lit(1)), 1, 100), F.lit(0.0))
        .alias("success_rate_pct"),
        "high_value_count",
        F.coalesce(F.col("top_operator"), F.lit("N/A")).alias("top_operator"),
        F.coalesce(F.col("top_region"), F.lit("N/A")).alias("top_region"),
    )


def metrics_snapshot(events: DataFrame) -> DataFrame:
    return snapshot_from(keyed_sums(events))
