"""Adapter from the driver's tables to the payments data model.

The engine works on a raw transaction feed (every column a string) and on
a live event stream. Test data arrives as ``events`` plus the customer ->
nation -> region dimension chain; these functions derive both inputs from
them with plain joins and column expressions, so the derived data grows
with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions.text import zero_pad
from paylake.schemas import RAW_COLUMNS, TOPIC_NAME, PARTITION_COUNT
from paylake.sources.tables import normalise_raw, table

# Fixed values of the adapter (event kind -> transaction type, etc.).
RAW_TYPE_BY_EVENT = {"click": "P2P", "view": "mbp ", "purchase": "WDR", "signup": "DEP", "error": "XYZ"}
LIVE_TYPE_BY_EVENT = {"click": "P2P", "view": "MBP", "purchase": "WDR", "signup": "DEP", "error": "AIRTIME"}
RAW_OPERATOR_BY_MOD3 = ["MTN", " Vodafone", "AirtelTigo"]
LIVE_OPERATOR_BY_MOD3 = ["MTN", "Vodafone", "AirtelTigo"]
REGION_RENAME = {"MIDDLE EAST": "Brong-Ahafo"}


def _pick(c: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == k, v) if expr is None else expr.when(c == k, v))
    return expr


def _by_mod3(c: Column, values: list) -> Column:
    m = F.pmod(c, F.lit(3))
    return F.when(m == 0, values[0]).when(m == 1, values[1]).otherwise(values[2])


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_nationkey -> r_name``: 25 rows at every scale factor."""
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
            .select("n_nationkey", "r_name"))


def _events_with_region(spark: SparkSession, sf_dir: str, region: bool = True) -> DataFrame:
    """events -> customer -> (nation -> region); without ``region`` the events alone.

    customer grows with the data, so its join is left to the optimizer's
    size statistics (broadcast only under the configured threshold, a
    shuffle join above it). The nation/region chain has a fixed size (25
    rows) and is always broadcast, after the customer join, so the event
    rows are never shuffled for it.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    if not region:
        return ev.withColumn("r_name", F.lit(None).cast("string"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = nation_regions(spark, sf_dir)
    return (ev.join(cust, ev.user_id == cust.c_custkey, "left")
            .join(F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey, "left"))


def _base_amount() -> Column:
    return F.col("value").cast("decimal(12,2)") * F.lit(10)


def _region_name() -> Column:
    r = F.col("r_name")
    out = None
    for k, v in REGION_RENAME.items():
        out = F.when(r == k, v) if out is None else out.when(r == k, v)
    return out.otherwise(r)


def raw_feed(spark: SparkSession, sf_dir: str, normalise: bool = True, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """The raw transaction feed: ``ingest_seq`` + the 11 string columns.

    Deterministic dirt is injected from ``event_id``: null ids, unparseable
    timestamps, bad/negative/NaN amounts, fee tokens, untrimmed/odd-cased
    text, unknown type codes, and a second copy of some rows (the next
    ``ingest_seq``; first copies have even ones). The duplicate copy is produced by a
    generator over the same scan, not by a second scan and a union. Only
    ``columns`` are derived: the dimension joins are left out without ``region``.
    """
    e = _events_with_region(spark, sf_dir, "region" in columns)
    eid = F.col("event_id")
    amt = _base_amount()
    copies = F.when(F.pmod(eid, F.lit(107)) == 19, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = e.select("*", F.explode(copies).alias("_copy"))
    status = F.pmod(eid, F.lit(25))
    df = e.select(
        (eid * 2 + F.col("_copy")).alias("ingest_seq"),
        F.when(F.pmod(eid, F.lit(101)) == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("TXN"), zero_pad(eid, 8))).alias("transaction_id"),
        F.when(F.pmod(eid, F.lit(103)) == 5, F.lit("invalid_date"))
         .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("timestamp"),
        F.when(F.pmod(eid, F.lit(89)) == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("024"), zero_pad(F.col("user_id"), 7))).alias("sender_msisdn"),
        F.concat(F.lit("055"), zero_pad(F.pmod(F.col("user_id") * 7919 + eid * 31, F.lit(500)), 7))
         .alias("receiver_msisdn"),
        F.when(F.pmod(eid, F.lit(97)) == 11, F.lit("N/A"))
         .when(F.pmod(eid, F.lit(109)) == 13, F.lit("-5.00"))
         .when(F.pmod(eid, F.lit(113)) == 17, F.lit("NaN"))
         .otherwise(amt.cast("string")).alias("amount"),
        F.when(F.pmod(eid, F.lit(37)) == 0, F.lit("USD")).otherwise(F.lit("GHS")).alias("currency"),
        _pick(F.col("event_type"), RAW_TYPE_BY_EVENT).alias("transaction_type"),
        _by_mod3(F.col("user_id"), RAW_OPERATOR_BY_MOD3).alias("operator"),
        F.when(status == 0, "FAILED").when(status == 1, "PENDING").when(status == 2, "REVERSED")
         .when(status == 3, "failed ").otherwise("SUCCESS").alias("status"),
        _region_name().alias("region"),
        F.when(F.pmod(eid, F.lit(61)) == 0, F.lit("N/A"))
         .otherwise(F.round(amt * F.lit(0.01), 2).cast("decimal(18,2)").cast("string")).alias("fee"),
    )
    df = df.select("ingest_seq", *columns)
    return normalise_raw(df) if normalise else df


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live event stream (one row per event, the A5 contract).

    Ten senders (``user_id % 10``) so that short gaps between one sender's
    events occur, some events without a sender and some with a time that
    can't be read; ``offset`` is the producer counter starting at 1.
    """
    e = _events_with_region(spark, sf_dir)
    eid = F.col("event_id")
    offset = eid + 1
    amt = _base_amount()
    et = F.col("event_type")
    amount_ghs = amt.cast("double")
    return e.select(
        F.lit("TRANSACTION").alias("event_type"),
        F.lit(TOPIC_NAME).alias("topic"),
        F.pmod(offset, F.lit(PARTITION_COUNT)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.when(F.pmod(eid, F.lit(79)) == 7, F.lit("garbage"))
         .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp"),
        F.concat(F.lit("TXN-LIVE-"), zero_pad(offset, 8)).alias("transaction_id"),
        F.when(F.pmod(eid, F.lit(83)) != 5, F.concat(F.lit("024"), zero_pad(F.pmod(F.col("user_id"), F.lit(10)), 7)))
         .alias("sender_msisdn"),
        F.concat(F.lit("055"), zero_pad(F.pmod(F.col("user_id") * 7919 + eid * 31, F.lit(500)), 7))
         .alias("receiver_msisdn"),
        amount_ghs.alias("amount_ghs"),
        F.round(amt * F.lit(0.01), 2).cast("decimal(18,2)").cast("double").alias("fee_ghs"),
        _pick(et, LIVE_TYPE_BY_EVENT).alias("transaction_type"),
        _by_mod3(F.col("user_id"), LIVE_OPERATOR_BY_MOD3).alias("operator"),
        F.when(et == "error", "FAILED").when(et == "signup", "PENDING").otherwise("SUCCESS").alias("status"),
        _region_name().alias("region"),
        (amt >= 500).alias("is_high_value"),
    )


def upsert_pair(clean_fact: DataFrame, seq_col: str = "ingest_seq") -> tuple[DataFrame, DataFrame]:
    """(existing, incoming) sides of a clean batch for upsert checks; every
    row is on at least one side, so the upsert result covers the whole batch.

    ``seq % 3``: 1 -> existing only (kept), 0 -> incoming only (inserted),
    2 -> both (updated). Incoming rows carry status ``REVERSED`` and
    amount + 1 (the amount must not change on update).
    """
    seq = F.col(seq_col)
    existing = clean_fact.where(F.pmod(seq, F.lit(3)) != 0)
    incoming = (clean_fact.where(F.pmod(seq, F.lit(3)) != 1)
                .withColumn("status", F.lit("REVERSED"))
                .withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)")))
    return existing, incoming
