"""Reporting marts over the staging frame.

Each mart is one aggregation. Group keys are low-cardinality (date,
operator, region), so every aggregate is partial on the map side before
the shuffle: a hot operator or region costs one row per map task.
Shares of the grand total are a window over the handful of grouped rows,
never over raw rows. Money sums stay decimal (exact) until the last
projection; percentages are exact half-up ratios (see functions.numeric).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.functions.calendar import padded_day_name, padded_month_name
from paylake.functions.numeric import avg_money, cents, half_up_ratio, money_double
from paylake.schemas import ALERT_REASONS, RISK_RANK


def _amt():
    return F.col("transaction_amount_ghs")


def _status():
    return F.col("transaction_status")


def _count_when(cond) -> "F.Column":
    return F.count(F.when(cond, F.lit(1)))


def _sum_when(cond, x) -> "F.Column":
    return F.sum(F.when(cond, x).otherwise(F.lit(0)))


def mart_daily(stg: DataFrame) -> DataFrame:
    """Revenue per transaction date (``is_weekend`` is a function of the date;
    names and date parts are computed after the aggregation)."""
    agg = stg.groupBy("transaction_date", "is_weekend").agg(
        F.count("transaction_id").alias("total_transactions"),
        _count_when(_status() == "SUCCESS").alias("successful_transactions"),
        _count_when(_status() == "FAILED").alias("failed_transactions"),
        _count_when(_status() == "REVERSED").alias("reversed_transactions"),
        F.sum(_amt()).alias("_gross"),
        _sum_when(_status() == "SUCCESS", _amt()).alias("_net"),
        F.sum("transaction_fee_ghs").alias("_fees"),
        F.count(_amt()).alias("_n_amt"),
        _count_when(F.col("is_high_value")).alias("high_value_count"),
        _sum_when(F.col("is_high_value"), _amt()).alias("_hv"),
    )
    return daily_rows(agg)


def daily_rows(agg: DataFrame) -> DataFrame:
    """The daily mart from its sums by date."""
    d = F.col("transaction_date")
    return agg.select(
        "transaction_date",
        F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        padded_month_name(d).alias("month_name"), padded_day_name(d).alias("day_name"),
        "is_weekend",
        "total_transactions", "successful_transactions", "failed_transactions", "reversed_transactions",
        money_double(F.col("_gross")).alias("gross_revenue_ghs"),
        money_double(F.col("_net")).alias("net_revenue_ghs"),
        money_double(F.col("_fees")).alias("total_fees_ghs"),
        avg_money(F.col("_gross"), F.col("_n_amt")).alias("avg_transaction_ghs"),
        "high_value_count",
        money_double(F.col("_hv")).alias("high_value_revenue_ghs"),
        half_up_ratio(F.col("successful_transactions"), F.col("total_transactions"), 2, 100).alias("success_rate_pct"),
    ).orderBy("transaction_date")


def _distinct(col: str, approx: bool):
    return F.approx_count_distinct(col) if approx else F.countDistinct(col)


def mart_operator(stg: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per-operator volume, value, type mix, rates and market shares.

    Exact distinct counts are planned as one ``Expand`` with the distinct
    values as shuffle keys (spread even for a hot operator);
    ``approx_distinct`` switches to HyperLogLog++ sketches (fixed-size
    buffers, no distinct shuffle)."""
    code = F.col("transaction_type_code")
    agg = stg.groupBy("operator").agg(
        F.count("transaction_id").alias("total_transactions"),
        _distinct("sender_msisdn", approx_distinct).alias("unique_senders"),
        _distinct("receiver_msisdn", approx_distinct).alias("unique_receivers"),
        F.sum(_amt()).alias("_sum"), F.count(_amt()).alias("_n_amt"),
        F.min(_amt()).alias("_min"), F.max(_amt()).alias("_max"),
        F.sum("transaction_fee_ghs").alias("_fees"),
        _count_when(code == "P2P").alias("p2p_count"),
        _count_when(code == "MBP").alias("merchant_payment_count"),
        _count_when(code == "WDR").alias("withdrawal_count"),
        _count_when(code == "DEP").alias("deposit_count"),
        _count_when(_status() == "SUCCESS").alias("_succ"),
        _count_when(_status() == "FAILED").alias("_fail"),
        _count_when(F.col("is_high_value")).alias("high_value_transactions"),
        _count_when(F.col("is_rapid_succession")).alias("rapid_succession_flags"),
    )
    return operator_rows(agg)


def operator_rows(agg: DataFrame) -> DataFrame:
    """The operator mart from its sums by operator."""
    everything = Window.partitionBy()
    return agg.select(
        "operator", "total_transactions", "unique_senders", "unique_receivers",
        money_double(F.col("_sum")).alias("total_volume_ghs"),
        avg_money(F.col("_sum"), F.col("_n_amt")).alias("avg_transaction_ghs"),
        money_double(F.col("_min")).alias("min_transaction_ghs"),
        money_double(F.col("_max")).alias("max_transaction_ghs"),
        money_double(F.col("_fees")).alias("total_fees_collected_ghs"),
        "p2p_count", "merchant_payment_count", "withdrawal_count", "deposit_count",
        half_up_ratio(F.col("_succ"), F.col("total_transactions"), 2, 100).alias("success_rate_pct"),
        half_up_ratio(F.col("_fail"), F.col("total_transactions"), 2, 100).alias("failure_rate_pct"),
        "high_value_transactions", "rapid_succession_flags",
        half_up_ratio(F.col("total_transactions"), F.sum("total_transactions").over(everything), 2, 100)
        .alias("market_share_by_volume_pct"),
        half_up_ratio(cents(F.col("_sum")), cents(F.sum("_sum").over(everything)), 2, 100)
        .alias("market_share_by_value_pct"),
    ).orderBy(F.desc("total_volume_ghs"), "operator")


def mart_region(stg: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per-region volume, customers, rates, peak hour and revenue share.

    ``peak_hour`` is the most frequent hour, smallest hour on ties
    (``mode() WITHIN GROUP (ORDER BY hour)``); the mode buffer holds at most
    24 hour values per group.
    """
    agg = stg.groupBy("region").agg(
        F.count("transaction_id").alias("total_transactions"),
        _distinct("sender_msisdn", approx_distinct).alias("unique_customers"),
        F.sum(_amt()).alias("_sum"), F.count(_amt()).alias("_n_amt"),
        F.sum("transaction_fee_ghs").alias("_fees"),
        _count_when(_status() == "SUCCESS").alias("_succ"),
        F.expr("mode() WITHIN GROUP (ORDER BY transaction_hour)").alias("peak_hour"),
        _count_when(F.col("is_weekend")).alias("weekend_transactions"),
        _count_when(F.col("is_high_value")).alias("high_value_count"),
        _sum_when(F.col("is_high_value"), _amt()).alias("_hv"),
    )
    return region_rows(agg)


def region_rows(agg: DataFrame) -> DataFrame:
    """The region mart from its sums by region."""
    everything = Window.partitionBy()
    return agg.select(
        "region", "total_transactions", "unique_customers",
        money_double(F.col("_sum")).alias("total_volume_ghs"),
        avg_money(F.col("_sum"), F.col("_n_amt")).alias("avg_transaction_ghs"),
        money_double(F.col("_fees")).alias("total_fees_ghs"),
        half_up_ratio(F.col("_succ"), F.col("total_transactions"), 2, 100).alias("success_rate_pct"),
        F.col("peak_hour").cast("int").alias("peak_hour"),
        "weekend_transactions",
        half_up_ratio(F.col("weekend_transactions"), F.col("total_transactions"), 2, 100).alias("weekend_pct"),
        "high_value_count",
        money_double(F.col("_hv")).alias("high_value_volume_ghs"),
        half_up_ratio(cents(F.col("_sum")), cents(F.sum("_sum").over(everything)), 2, 100)
        .alias("revenue_share_pct"),
    ).orderBy(F.desc("total_volume_ghs"), "region")


def risk_level(hv, rapid) -> "F.Column":
    return (F.when(hv & rapid, "CRITICAL").when(hv, "HIGH").when(rapid, "MEDIUM").otherwise("LOW"))


def alert_reason(hv, rapid) -> "F.Column":
    return (F.when(hv & rapid, ALERT_REASONS["CRITICAL"]).when(hv, ALERT_REASONS["HIGH"])
            .when(rapid, ALERT_REASONS["MEDIUM"]).otherwise(ALERT_REASONS["LOW"]))


def flagged(stg: DataFrame, with_loaded_at: bool = False) -> DataFrame:
    """Flagged transactions with a risk class and an alert reason."""
    hv, rapid = F.col("is_high_value"), F.col("is_rapid_succession")
    cols = [
        "transaction_id", "transaction_date", "transaction_hour", "day_of_week", "is_weekend",
        "sender_msisdn", "receiver_msisdn", "operator", "region",
        "transaction_amount_ghs", "transaction_fee_ghs", "total_debit_ghs",
        "transaction_type_label", "transaction_status", "amount_bucket", "currency",
        "is_high_value", "is_rapid_succession", "secs_since_last_txn",
        risk_level(hv, rapid).alias("risk_level"), alert_reason(hv, rapid).alias("alert_reason"),
    ]
    if with_loaded_at:
        cols.append("loaded_at")
    return stg.where((hv == True) | (rapid == True)).select(*cols)  # noqa: E712


def ordered_high_value(rows: DataFrame) -> DataFrame:
    """By risk rank, then amount (largest first)."""
    rank = F.coalesce(*[F.when(F.col("risk_level") == k, F.lit(v)) for k, v in RISK_RANK.items()])
    return rows.orderBy(rank, F.desc("transaction_amount_ghs"), "transaction_id")


def mart_high_value(stg: DataFrame, with_loaded_at: bool = False) -> DataFrame:
    """Flagged transactions with a risk class and an alert reason, ordered
    by risk rank then amount (largest first)."""
    return ordered_high_value(flagged(stg, with_loaded_at))


# --- mergeable sums -----------------------------------------------------------

def partial_sums(stg: DataFrame) -> DataFrame:
    """Additive sums by (date, operator, region, hour): what every mart but the flagged rows
    and the numbers of different subscribers is made of."""
    code = F.col("transaction_type_code")
    return stg.groupBy("transaction_date", "is_weekend", "operator", "region", "transaction_hour").agg(
        F.count("transaction_id").alias("n"), F.count(_amt()).alias("n_amt"), F.sum(_amt()).alias("amount"),
        F.min(_amt()).alias("least"), F.max(_amt()).alias("most"), F.sum("transaction_fee_ghs").alias("fees"),
        *[_count_when(_status() == x.upper()).alias(x) for x in ("success", "failed", "reversed")],
        _sum_when(_status() == "SUCCESS", _amt()).alias("net"),
        _count_when(F.col("is_high_value")).alias("high"), _sum_when(F.col("is_high_value"), _amt()).alias("high_amount"),
        _count_when(F.col("is_rapid_succession")).alias("rapid"),
        *[_count_when(code == x.upper()).alias(x) for x in ("p2p", "mbp", "wdr", "dep")],
    )


def merge(sums: DataFrame, *by: str) -> DataFrame:
    """The columns that :func:`daily_rows` and :func:`operator_rows` take, from partial sums."""
    named = {"total_transactions": "n", "successful_transactions": "success", "failed_transactions": "failed",
             "reversed_transactions": "reversed", "_gross": "amount", "_sum": "amount", "_net": "net", "_fees": "fees", "_n_amt": "n_amt",
             "high_value_count": "high", "high_value_transactions": "high", "_hv": "high_amount", "rapid_succession_flags": "rapid",
             "_succ": "success", "_fail": "failed", "p2p_count": "p2p", "merchant_payment_count": "mbp", "withdrawal_count": "wdr",
             "deposit_count": "dep"}
    return sums.groupBy(*by).agg(*[F.sum(c).alias(name) for name, c in named.items()], F.min("least").alias("_min"), F.max("most").alias("_max"))


def merge_regions(sums: DataFrame) -> DataFrame:
    """The columns that :func:`region_rows` takes. The peak hour is that of most rows, the
    smallest of ties: hours are merged first, then the regions' at most 24 hours."""
    hours = sums.groupBy("region", "transaction_hour").agg(
        F.sum("n").alias("n"), F.sum("n_amt").alias("n_amt"), F.sum("amount").alias("amount"), F.sum("fees").alias("fees"),
        F.sum("success").alias("success"), F.sum(F.when(F.col("is_weekend"), F.col("n")).otherwise(0)).alias("weekend"),
        F.sum("high").alias("high"), F.sum("high_amount").alias("high_amount"))
    return hours.groupBy("region").agg(
        F.sum("n").alias("total_transactions"), F.sum("amount").alias("_sum"), F.sum("n_amt").alias("_n_amt"), F.sum("fees").alias("_fees"),
        F.sum("success").alias("_succ"), F.min(F.struct(-F.col("n"), F.col("transaction_hour").alias("hour")))["hour"].alias("peak_hour"),
        F.sum("weekend").alias("weekend_transactions"), F.sum("high").alias("high_value_count"), F.sum("high_amount").alias("_hv"))
