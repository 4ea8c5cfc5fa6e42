"""The staging view: rename to the reporting contract, filter valid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.numeric import cents, half_up_ratio
from paylake.functions.text import initcap_words
from paylake.schemas import ACCEPTED_STATUSES, GAP_TYPE

GAP = f"decimal({GAP_TYPE[0]},{GAP_TYPE[1]})"

STAGING_COLUMNS = [
    "transaction_id", "transaction_timestamp", "transaction_date", "transaction_hour",
    "day_of_week", "transaction_month", "transaction_quarter", "is_weekend",
    "sender_msisdn", "receiver_msisdn", "transaction_amount_ghs", "transaction_fee_ghs",
    "total_debit_ghs", "fee_rate_pct", "transaction_type_code", "transaction_type_label",
    "currency", "amount_bucket", "operator", "transaction_status", "region",
    "is_high_value", "is_rapid_succession", "secs_since_last_txn",
]


def stg_transactions(fact: DataFrame, with_loaded_at: bool = False) -> DataFrame:
    """Fact-shaped rows -> staging rows (25 columns with ``loaded_at``).

    ``fee_rate_pct = round(fee / nullif(amount, 0) * 100, 4)`` is an exact
    half-up ratio of cents (a double); the filter keeps non-null ids, positive amounts and the four
    known statuses (a null status is dropped here).
    """
    amount, fee = F.col("amount"), F.col("fee")
    fee_rate = half_up_ratio(cents(fee), cents(amount), 4, 100)
    cols = [
        F.col("transaction_id"),
        F.col("timestamp").alias("transaction_timestamp"),
        F.col("txn_date").alias("transaction_date"),
        F.col("txn_hour").alias("transaction_hour"),
        F.col("txn_day_of_week").alias("day_of_week"),
        F.col("txn_month").alias("transaction_month"),
        F.col("txn_quarter").alias("transaction_quarter"),
        F.col("is_weekend"),
        F.upper(F.trim(F.col("sender_msisdn"))).alias("sender_msisdn"),
        F.upper(F.trim(F.col("receiver_msisdn"))).alias("receiver_msisdn"),
        amount.alias("transaction_amount_ghs"),
        fee.alias("transaction_fee_ghs"),
        F.col("total_debit").alias("total_debit_ghs"),
        fee_rate.alias("fee_rate_pct"),
        F.upper(F.col("transaction_type")).alias("transaction_type_code"),
        F.col("transaction_type_label"),
        F.upper(F.col("currency")).alias("currency"),
        F.col("amount_bucket"),
        F.upper(F.col("operator")).alias("operator"),
        F.upper(F.col("status")).alias("transaction_status"),
        initcap_words(F.col("region")).alias("region"),
        F.col("is_high_value"),
        F.col("is_rapid_succession"),
        F.coalesce(F.col("time_since_last_txn_sec").cast(GAP), F.lit(0).cast(GAP))
         .alias("secs_since_last_txn"),
    ]
    if with_loaded_at:
        cols.append(F.col("loaded_at"))
    keep = (F.col("transaction_id").isNotNull() & (amount > 0)
            & F.col("status").isin(ACCEPTED_STATUSES))
    return fact.where(keep).select(*cols)
