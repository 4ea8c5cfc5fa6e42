"""Schemas and business constants of the payments engine.

Everything here is data, not logic: the column contracts of the raw feed,
the fact table, the audit table, the live event and the fraud alert, plus
the fixed values that must agree with the original pipeline for results
to agree.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match)
# ---------------------------------------------------------------------------

# Transaction type code -> readable label; anything else is "Unknown".
TYPE_LABELS = {
    "P2P": "Peer to Peer Transfer",
    "MBP": "Merchant Bill Payment",
    "WDR": "Withdrawal",
    "DEP": "Deposit",
    "INTL": "International Transfer",
    "AIRTIME": "Airtime Top-Up",
}
UNKNOWN_LABEL = "Unknown"

# Accepted values checked by the staging data tests.
ACCEPTED_OPERATORS = ["MTN", "VODAFONE", "AIRTELTIGO"]
ACCEPTED_STATUSES = ["SUCCESS", "FAILED", "PENDING", "REVERSED"]

# Right-closed amount bins: (0,50] (50,200] (200,500] (500,1000] (1000,inf).
AMOUNT_BUCKETS = [
    (50, "Micro (<50)"),
    (200, "Small (50-200)"),
    (500, "Medium (200-500)"),
    (1000, "Large (500-1k)"),
]
AMOUNT_BUCKET_TOP = "High Value (1k+)"

# Batch flags.
HIGH_VALUE_QUANTILE = 0.95
RAPID_GAP_SECONDS = 120

# Live (stream) flags.
LIVE_HIGH_VALUE_GHS = 500
LIVE_RAPID_GAP_SECONDS = 10
LIVE_FAILED_HIGH_GHS = 200
TOPIC_NAME = "momo.transactions.live"
PARTITION_COUNT = 3

# Risk classes of the high-value mart and their sort rank.
RISK_RANK = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}
ALERT_REASONS = {
    "CRITICAL": "High-value rapid succession — immediate review required",
    "HIGH": "High-value transaction — above 95th percentile",
    "MEDIUM": "Rapid succession — multiple txns within 2 minutes",
    "LOW": "Monitoring",
}

# Tokens that a pandas-style CSV read turns into null in every column
# (pandas' default ``na_values``).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Precision and scale of fees, debits and gaps: wide enough that no value that
# passes validation can overflow (a debit is an amount plus a fee).
FEE_TYPE = (18, 2)
DEBIT_TYPE = (20, 2)
GAP_TYPE = (18, 2)

# Declared timestamp text format: seconds, with an optional fraction.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RAW_COLUMNS = [
    "transaction_id", "timestamp", "sender_msisdn", "receiver_msisdn",
    "amount", "currency", "transaction_type", "operator", "status",
    "region", "fee",
]
RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Column order of the fact table (``loaded_at`` is added by the loader).
FACT_COLUMNS = [
    "transaction_id", "timestamp", "txn_date", "txn_hour", "txn_day_of_week",
    "txn_month", "txn_quarter", "is_weekend", "sender_msisdn",
    "receiver_msisdn", "amount", "fee", "total_debit", "currency",
    "transaction_type", "transaction_type_label", "amount_bucket", "operator",
    "status", "region", "is_high_value", "is_rapid_succession",
    "time_since_last_txn_sec",
]

FACT = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("txn_date", T.DateType(), True),
    T.StructField("txn_hour", T.IntegerType(), True),
    T.StructField("txn_day_of_week", T.StringType(), True),
    T.StructField("txn_month", T.IntegerType(), True),
    T.StructField("txn_quarter", T.IntegerType(), True),
    T.StructField("is_weekend", T.BooleanType(), True),
    T.StructField("sender_msisdn", T.StringType(), True),
    T.StructField("receiver_msisdn", T.StringType(), True),
    T.StructField("amount", T.DecimalType(12, 2), True),
    T.StructField("fee", T.DecimalType(*FEE_TYPE), True),
    T.StructField("total_debit", T.DecimalType(*DEBIT_TYPE), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("transaction_type", T.StringType(), True),
    T.StructField("transaction_type_label", T.StringType(), True),
    T.StructField("amount_bucket", T.StringType(), True),
    T.StructField("operator", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("is_high_value", T.BooleanType(), False),
    T.StructField("is_rapid_succession", T.BooleanType(), False),
    T.StructField("time_since_last_txn_sec", T.DecimalType(*GAP_TYPE), True),
    T.StructField("loaded_at", T.TimestampType(), True),
])

AUDIT = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_timestamp", T.TimestampType(), True),
    T.StructField("run_date", T.DateType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("partitions_written", T.LongType(), True),
    T.StructField("raw_count", T.LongType(), True),
    T.StructField("clean_count", T.LongType(), True),
    T.StructField("high_value_flagged", T.LongType(), True),
    T.StructField("rapid_succession_flagged", T.LongType(), True),
    T.StructField("success_rate_pct", T.DoubleType(), True),
    T.StructField("issues", T.StringType(), True),
])

EVENT = T.StructType([
    T.StructField("event_type", T.StringType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("sender_msisdn", T.StringType(), True),
    T.StructField("receiver_msisdn", T.StringType(), True),
    T.StructField("amount_ghs", T.DoubleType(), True),
    T.StructField("fee_ghs", T.DoubleType(), True),
    T.StructField("transaction_type", T.StringType(), True),
    T.StructField("operator", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("is_high_value", T.BooleanType(), True),
])
