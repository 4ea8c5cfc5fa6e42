"""Row-wise enrichment: text standardisation, labels, calendar, buckets,
totals. All narrow projections (no shuffle), kept inside codegen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions import calendar
from paylake.functions.text import strip_upper, type_label
from paylake.schemas import AMOUNT_BUCKETS, AMOUNT_BUCKET_TOP, DEBIT_TYPE

TEXT_COLUMNS = ["transaction_type", "status", "operator", "currency", "region"]


def standardise_text(df: DataFrame, cols=TEXT_COLUMNS) -> DataFrame:
    """Strip surrounding whitespace and upper-case the categorical columns."""
    return df.withColumns({c: strip_upper(F.col(c)) for c in cols})


def add_type_label(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_type_label", type_label(F.col("transaction_type")))


def add_time_dims(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    t = F.col(ts)
    return df.withColumns({
        "txn_date": F.to_date(t),
        "txn_hour": F.hour(t),
        "txn_day_of_week": calendar.day_name(t),
        "txn_month": F.month(t),
        "txn_quarter": F.quarter(t),
        "is_weekend": calendar.is_weekend(t),
    })


def amount_bucket(amount) -> "F.Column":
    """Right-closed bins: (0,50] -> Micro ... (1000, inf) -> High Value."""
    expr = None
    for upper, label in AMOUNT_BUCKETS:
        cond = amount <= F.lit(upper)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(amount > F.lit(AMOUNT_BUCKETS[-1][0]), AMOUNT_BUCKET_TOP)


def add_amount_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_bucket", amount_bucket(F.col("amount")))


def add_total_debit(df: DataFrame) -> DataFrame:
    """amount + fee, exact decimal addition (the type holds any sum of the two)."""
    return df.withColumn("total_debit", (F.col("amount") + F.col("fee")).cast(f"decimal({DEBIT_TYPE[0]},{DEBIT_TYPE[1]})"))


def enrich(df: DataFrame) -> DataFrame:
    """All row-wise enrichment steps in pipeline order."""
    df = standardise_text(df)
    df = add_type_label(df)
    df = add_time_dims(df)
    df = add_amount_bucket(df)
    return df
