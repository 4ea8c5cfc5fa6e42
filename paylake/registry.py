"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the data directory's tables (through the fixture
adapter) and runs over all of it. Results are shaped for comparison:
money decimals become doubles in the final projection only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions import parse as P
from paylake.functions import text as TX
from paylake.functions.numeric import cents, half_up_ratio
from paylake.operators import clean as C
from paylake.operators import enrich as E
from paylake.operators import fact as FT
from paylake.operators import quality as Q
from paylake.operators.flags import quantile_frame
from paylake.operators.report import summary_by_type, top_regions
from paylake.plans import marts as M
from paylake.plans.batch import transform
from paylake.plans.incremental import HIGH_VALUE, SKETCH_BITS, MartFolder, refresh_marts
from paylake.plans.staging import stg_transactions
from paylake.replay import range_size, replay_in_order
from paylake.sources import fixtures as FX
from paylake.sources.tables import read_raw_csv, write_raw_csv
from paylake.streaming import fraud as FR
from paylake.streaming import jobs as J
from paylake.streaming import metrics as MT
from paylake.schemas import EVENT, FEE_TYPE, RAW_COLUMNS
from paylake.session import materialize, release

Query = Callable[[SparkSession, str], DataFrame]


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`") for f in df.schema.fields
    ])


def _raw(spark, sf, columns=RAW_COLUMNS):
    return FX.raw_feed(spark, sf, columns=columns)


def _t(spark, sf):
    return transform(_raw(spark, sf))


def _clean(spark, sf):
    return _t(spark, sf).clean


def _fact(spark, sf):
    return FT.fact_rows(_clean(spark, sf))


def _stg(spark, sf):
    return stg_transactions(_fact(spark, sf))


def _survivors(spark, sf):
    return C.dedup_first(_raw(spark, sf))


# --- sources ---------------------------------------------------------------

def scan_raw(spark, sf):
    return _raw(spark, sf)


def scan_clean(spark, sf):
    """The clean stage as a run stores it, read back with its types."""
    clean, path = _clean(spark, sf), J.scratch(spark, "clean")
    FT.write_by_date(clean, path)
    return decimals_to_double(spark.read.schema(clean.schema).parquet(path).drop("ingest_seq"))


def scan_fact(spark, sf):
    """The fact table after its first publication."""
    root = J.scratch(spark, "fact")
    FT.publish_fact(spark, root, FT.fact_rows(_clean(spark, sf), loaded_at=True))
    return decimals_to_double(FT.read_fact(spark, root).drop("loaded_at"))


def fact_rows(spark, sf):
    return decimals_to_double(_fact(spark, sf).select("transaction_id", "amount", "fee", "total_debit",
                                                      "time_since_last_txn_sec", "txn_hour", "status"))


# --- cleaning --------------------------------------------------------------

def dedup_first(spark, sf):
    return _survivors(spark, sf)


def reject_funnel(spark, sf):
    raw = _raw(spark, sf, ["transaction_id", "timestamp", "amount", "fee"])
    return C.reject_funnel(raw, C.classify(raw))


def parse_timestamp(spark, sf):
    s = _survivors(spark, sf)
    return s.select("transaction_id", F.col("timestamp").alias("timestamp_text"),
                    P.parse_timestamp(F.col("timestamp")).alias("timestamp"))


def parse_amount(spark, sf):
    s = _survivors(spark, sf)
    fee = F.coalesce(P.parse_decimal(F.col("fee"), *FEE_TYPE), F.lit(0).cast("decimal(18,2)"))
    return decimals_to_double(s.select(
        "transaction_id", F.col("amount").alias("amount_text"), F.col("fee").alias("fee_text"),
        P.parse_decimal(F.col("amount"), 12, 2).alias("amount"), fee.alias("fee")))


def standardise_text(spark, sf):
    s = _survivors(spark, sf).select("transaction_id", *E.TEXT_COLUMNS)
    return E.standardise_text(s)


def initcap_region(spark, sf):
    c = _clean(spark, sf)
    return (c.groupBy("region").agg(F.count(F.lit(1)).alias("rows"))
            .select("region", TX.initcap_words(F.col("region")).alias("region_title"), "rows"))


def type_label(spark, sf):
    return (_clean(spark, sf).groupBy("transaction_type", "transaction_type_label")
            .agg(F.count(F.lit(1)).alias("rows")))


def time_dims(spark, sf):
    return _clean(spark, sf).select("transaction_id", "timestamp", "txn_date", "txn_hour",
                                    "txn_day_of_week", "txn_month", "txn_quarter", "is_weekend")


def amount_bucket(spark, sf):
    return decimals_to_double(_clean(spark, sf).select("transaction_id", "amount", "amount_bucket"))


def total_debit(spark, sf):
    return decimals_to_double(_clean(spark, sf).select("transaction_id", "amount", "fee", "total_debit"))


def fee_rate(spark, sf):
    return _stg(spark, sf).select("transaction_id", "fee_rate_pct")


# --- flags -----------------------------------------------------------------

def p95_threshold(spark, sf):
    raw = _raw(spark, sf, ["transaction_id", "timestamp", "amount", "fee"])
    q = quantile_frame(C.clean_rows(C.classify(raw)))
    return q.select(F.round("p95_amount", 6).alias("p95_amount"))


def high_value_flag(spark, sf):
    return decimals_to_double(_clean(spark, sf).select("transaction_id", "amount", "is_high_value"))


def rapid_succession(spark, sf):
    return _clean(spark, sf).select("transaction_id", "sender_msisdn", "timestamp",
                                    "time_since_last_txn_sec", "is_rapid_succession")


# --- reports ---------------------------------------------------------------

def quality_report_q(spark, sf):
    t = _t(spark, sf)
    return t.report().drop("issues")


def summary_by_type_q(spark, sf):
    return summary_by_type(_clean(spark, sf))


def top_regions_q(spark, sf):
    return top_regions(_clean(spark, sf))


def audit_row(spark, sf):
    t = _t(spark, sf)
    return FT.audit_row(spark, t.report(), "oracle").drop("run_id", "run_timestamp", "run_date",
                                                           "partitions_written")


# --- staging and marts -----------------------------------------------------

def stg_q(spark, sf):
    return decimals_to_double(_stg(spark, sf))


def mart_daily(spark, sf):
    return M.mart_daily(_stg(spark, sf))


def mart_operator(spark, sf):
    return M.mart_operator(_stg(spark, sf))


def mart_region(spark, sf):
    return M.mart_region(_stg(spark, sf))


def mart_high_value(spark, sf):
    return decimals_to_double(M.mart_high_value(_stg(spark, sf)))


def market_share(spark, sf):
    stg = _stg(spark, sf)
    op = M.mart_operator(stg).select(
        F.lit("operator").alias("dimension"), F.col("operator").alias("member"),
        F.col("market_share_by_volume_pct").alias("share_by_volume_pct"),
        F.col("market_share_by_value_pct").alias("share_by_value_pct"))
    reg = (stg.groupBy("region").agg(F.count("transaction_id").alias("n"), F.sum("transaction_amount_ghs").alias("v")))
    w = Window.partitionBy()
    reg = reg.select(F.lit("region").alias("dimension"), F.col("region").alias("member"),
                     half_up_ratio(F.col("n"), F.sum("n").over(w), 2, 100).alias("share_by_volume_pct"),
                     half_up_ratio(cents(F.col("v")), cents(F.sum("v").over(w)), 2, 100).alias("share_by_value_pct"))
    return op.unionByName(reg)


def peak_hour(spark, sf):
    return M.mart_region(_stg(spark, sf)).select("region", "peak_hour")


def risk_level(spark, sf):
    s = _stg(spark, sf)
    hv, rapid = F.col("is_high_value"), F.col("is_rapid_succession")
    return s.select("transaction_id", M.risk_level(hv, rapid).alias("risk_level"),
                    M.alert_reason(hv, rapid).alias("alert_reason"))


# --- data quality ----------------------------------------------------------

def dq_unique(spark, sf):
    return Q.duplicate_keys(_stg(spark, sf))


def dq_not_null(spark, sf):
    s = _stg(spark, sf)
    return Q.null_counts(s, ["transaction_id", "transaction_amount_ghs", "transaction_timestamp", "amount_bucket"])


def dq_accepted_operator(spark, sf):
    return Q.bad_operators(_stg(spark, sf))


def dq_accepted_status(spark, sf):
    return Q.bad_statuses(_stg(spark, sf))


def dq_type_labels(spark, sf):
    return Q.bad_type_labels(_clean(spark, sf))


def dq_positive_amount(spark, sf):
    return decimals_to_double(Q.non_positive_amounts(_clean(spark, sf)).select("transaction_id", "amount"))


def dq_total_debit(spark, sf):
    return decimals_to_double(Q.total_debit_mismatch(_clean(spark, sf))
                              .select("transaction_id", "amount", "fee", "total_debit"))


def dq_report_bounds(spark, sf):
    return Q.report_bounds(_t(spark, sf).report())


# The same rules on inputs that break them: the raw feed before cleaning, and frames with
# seeded faults, so that every rule has rows to find.

def dq_unique_dirty(spark, sf):
    return Q.duplicate_keys(_raw(spark, sf))


def dq_accepted_operator_dirty(spark, sf):
    return Q.bad_operators(_raw(spark, sf))


def dq_accepted_status_dirty(spark, sf):
    return Q.bad_statuses(_raw(spark, sf).withColumnRenamed("status", "transaction_status"))


def dq_type_labels_dirty(spark, sf):
    """Every fifth row's label is its code."""
    c = _clean(spark, sf)
    fifth = F.pmod(F.col("ingest_seq"), F.lit(5)) == 0
    return Q.bad_type_labels(c.withColumn("transaction_type_label", F.when(fifth, F.col("transaction_type"))
                                          .otherwise(F.col("transaction_type_label"))))


def dq_positive_amount_dirty(spark, sf):
    """The typed rows before the reject rules."""
    return decimals_to_double(Q.non_positive_amounts(C.classify(_raw(spark, sf))).select("transaction_id", "amount"))


def dq_total_debit_dirty(spark, sf):
    """Every seventh row's debit lacks the fee, every eleventh's is missing."""
    seq, debit = F.col("ingest_seq"), F.col("total_debit")
    c = _clean(spark, sf).withColumn("total_debit", F.when(F.pmod(seq, F.lit(11)) == 0, F.lit(None))
                                     .when(F.pmod(seq, F.lit(7)) == 0, F.col("amount")).otherwise(debit))
    return decimals_to_double(Q.total_debit_mismatch(c).select("transaction_id", "amount", "fee", "total_debit"))


def dq_report_bounds_dirty(spark, sf):
    """A report whose clean count is one above the raw count, with a rate of -1."""
    r = _t(spark, sf).report()
    return Q.report_bounds(r.withColumn("clean_count", F.col("raw_count") + 1).withColumn("success_rate_pct", F.lit(-1.0)))


def dirty_profile(spark, sf):
    raw = FX.raw_feed(spark, sf, normalise=False)
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_ids"),
        F.count_if(F.col("amount").eqNullSafe("N/A")).alias("na_amounts"),
        F.count_if(F.col("amount").eqNullSafe("NaN")).alias("nan_amounts"),
        F.count_if(F.col("timestamp").eqNullSafe("invalid_date")).alias("invalid_dates"),
        F.count_if(F.col("sender_msisdn").isNull()).alias("null_senders"),
        F.count_if(F.col("fee").eqNullSafe("N/A")).alias("na_fees"),
        (F.count(F.lit(1)) - F.countDistinct("transaction_id") - F.count_if(F.col("transaction_id").isNull()))
        .alias("duplicate_copies"),
    )


def distinct_operators(spark, sf):
    s = _stg(spark, sf)
    return s.groupBy("operator").agg(F.count(F.lit(1)).alias("rows"))


# --- fact upsert -----------------------------------------------------------

def _upsert_sides(spark, sf):
    """Both sides from one stored clean stage, which is derived from the stored de-duplicated
    rows, as in a run: its branches don't repeat the de-duplication."""
    t = transform(_raw(spark, sf), stage=True, numbered=False)
    clean = materialize(t.clean, "clean")
    release(spark, t.staged)
    return FX.upsert_pair(clean)


def fact_upsert(spark, sf):
    existing, incoming = FX.upsert_pair(_clean(spark, sf))  # nothing runs before the result is used
    cols = ["transaction_id", "timestamp", "amount", "fee", "status", "is_high_value", "is_rapid_succession"]
    out = FT.upsert(existing.select(*cols), incoming.select(*cols))
    return decimals_to_double(out)


def fact_publish(spark, sf):
    """Two publications of the stored fact table (all 23 columns): first the rows of the
    existing side, then the incoming batch as an upsert."""
    root = J.scratch(spark, "fact")
    for batch in _upsert_sides(spark, sf):
        FT.publish_fact(spark, root, FT.fact_rows(batch, loaded_at=True))
    return decimals_to_double(FT.read_fact(spark, root).drop("loaded_at"))


def _followed_marts(spark, sf) -> MartFolder:
    """Marts refreshed after each of two publications: the existing side, then those rows of the
    incoming batch that have an odd day, so that the second refresh finds half of the dates touched."""
    fact, marts = J.scratch(spark, "fact"), J.scratch(spark, "marts")
    existing, incoming = _upsert_sides(spark, sf)
    for batch in (existing, incoming.where(F.dayofmonth("txn_date") % 2 == 1)):
        FT.publish_fact(spark, fact, FT.fact_rows(batch, loaded_at=True))
        refresh_marts(spark, fact, marts)
    return MartFolder(spark, marts)


def mart_daily_incremental(spark, sf):
    return _followed_marts(spark, sf).mart("mart_daily_revenue")


def mart_operator_incremental(spark, sf):
    return _followed_marts(spark, sf).mart("mart_operator_performance")


def mart_region_incremental(spark, sf):
    return _followed_marts(spark, sf).mart("mart_region_summary")


def mart_high_value_incremental(spark, sf):
    return decimals_to_double(_followed_marts(spark, sf).mart(HIGH_VALUE))


def subscriber_counts(spark, sf):
    """Different subscribers by merged bitmaps, and whether the merged sketches are within three
    standard errors of them."""
    c = _followed_marts(spark, sf).subscriber_counts()
    close = F.abs(F.col("estimate") - F.col("n")) <= F.ceil(F.col("n") * (3 * 1.04 / 2 ** (SKETCH_BITS / 2)))
    return c.select("dimension", "member", "n", close.alias("sketch_close"))


# --- stream twins ----------------------------------------------------------

def partition_slice(spark, sf):
    ev = FX.live_events(spark, sf)
    return (FR.with_queue_partition(ev).groupBy("queue_partition")
            .agg(F.count(F.lit(1)).alias("events"), F.min("offset").alias("first_offset"),
                 F.max("offset").alias("last_offset")))


def fraud_alerts(spark, sf):
    a = FR.fraud_alerts(FX.live_events(spark, sf))
    return a.select("transaction_id", "amount_ghs", "operator", "region",
                    F.size("alerts").alias("n_alerts"), F.array_join("alerts", " + ").alias("alerts_text"))


def metrics_totals(spark, sf):
    return MT.metrics_totals(FX.live_events(spark, sf))


def metrics_by_key(spark, sf):
    return MT.metrics_by_key(FX.live_events(spark, sf))


def metrics_snapshot(spark, sf):
    return MT.metrics_snapshot(FX.live_events(spark, sf))


# --- CSV source round trip -------------------------------------------------

def csv_funnel(spark, sf):
    """The raw feed written as CSV in input order, scanned back with the
    all-string CSV reader (null tokens, file-order ``ingest_seq``), then the
    reject funnel: first-copy-wins must follow the file order."""
    path = J.scratch(spark, "raw-csv")
    write_raw_csv(FX.raw_feed(spark, sf, normalise=False), path)
    raw = read_raw_csv(spark, path)
    return C.reject_funnel(raw, C.classify(raw))


def csv_scan(spark, sf):
    """All rows and columns of a CSV feed whose columns come in another order and whose
    regions hold quotes, commas and line breaks."""
    path = J.scratch(spark, "raw-csv")
    region = F.concat(F.lit('Zone "'), F.col("region"), F.lit('",\n'), F.col("transaction_type"))
    feed = FX.raw_feed(spark, sf, normalise=False).withColumn("region", region)
    write_raw_csv(feed, path, columns=RAW_COLUMNS[::-1])
    return read_raw_csv(spark, path).drop("ingest_seq")


# --- streaming jobs (file source, several micro-batches, drained) ----------

PARTS = 4
#: For jobs whose micro-batches are to be the replayed ranges: as much as there is.
WHOLE = (1 << 62)


def _run_all(starts, spark, sf, parts=PARTS, bytes_per_batch=None):
    """Replay the live events in offset order, ``parts`` ranges, each drained (and the queries
    restarted from their checkpoints) before the next is appended, for jobs that read the
    same folder side by side like consumers of one topic; return the sink folders.

    ``starts``: how to start a job, and whether it orders events over the micro-batches of a range."""
    src = J.scratch(spark, "events-in")
    jobs = [(start, reorder, J.scratch(spark, "out"), J.scratch(spark, "ckpt")) for start, reorder in starts]
    events = FX.live_events(spark, sf)
    reach = range_size(events, parts) if any(reorder for _, reorder in starts) else None

    def drain(end=False):
        # only jobs that reorder wait for the end mark
        J.drain([start(J.read_events(spark, src, bytes_per_batch=bytes_per_batch), out, ckpt, **({"reorder": reach} if reorder else {}))
                 for start, reorder, out, ckpt in jobs if reorder or not end])

    replay_in_order(events, src, parts, drain, reach, lambda: drain(end=True))
    return [out for _, _, out, _ in jobs]


def _run(start, spark, sf, parts=PARTS, bytes_per_batch=None, reorder=False):
    """:func:`_run_all` for one job."""
    return _run_all([(start, reorder)], spark, sf, parts, bytes_per_batch)[0]


def stream_scan(spark, sf):
    def start(ev, out, ckpt):
        return (ev.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    return spark.read.schema(EVENT).parquet(_run(start, spark, sf))


def stream_log(spark, sf):
    return spark.read.schema(EVENT).json(_run(J.start_log, spark, sf))


def stream_rapid(spark, sf):
    out = _run(J.start_gaps, spark, sf, reorder=True)
    return spark.read.parquet(out).select("transaction_id", "offset", "sender_msisdn", "gap_sec")


def stream_alerts(spark, sf):
    a = spark.read.parquet(_run(J.start_alerts, spark, sf, reorder=True))
    return a.select("transaction_id", "amount_ghs", "operator", "region",
                    F.size("alerts").alias("n_alerts"), F.array_join("alerts", " + ").alias("alerts_text"))


def stream_alert_csv(spark, sf):
    schema = "transaction_id string, amount_ghs double, operator string, region string, alerts string, detected_at timestamp"
    out = _run(J.start_alert_csv, spark, sf, reorder=True)
    return spark.read.schema(schema).option("header", True).csv(out).drop("detected_at")


def stream_snapshots(spark, sf):
    """One row per trigger of the metrics job; a trigger takes all of a range."""
    rows = J.read_snapshots(spark, _run(J.start_metrics, spark, sf, bytes_per_batch=WHOLE))
    return rows.select(F.col("batch_id").cast("int").alias("batch_id"), "total_transactions", "total_volume_ghs", "high_value_count")


def stream_throughput(spark, sf):
    """Rows that each consumer took over its whole run, as its listener counted them."""
    counted = J.Throughput()
    consumers = {"log": (J.start_log, False), "alerts": (J.start_alerts, True), "metrics": (J.start_metrics, False)}
    last = {}

    def observed_start(name, start):
        def started(events, *args, **options):
            last[name] = start(J.observed(events), *args, **options)
            return last[name]
        return started

    spark.streams.addListener(counted)
    try:
        _run_all([(observed_start(name, start), reorder) for name, (start, reorder) in consumers.items()], spark, sf)
        rows = [(name, counted.summary(last[name])["input_rows"]) for name in consumers]
    finally:
        spark.streams.removeListener(counted)
    return spark.createDataFrame(rows, "consumer string, input_rows long")


def stream_metrics(spark, sf):
    return J.read_snapshot(spark, _run(J.start_metrics, spark, sf))


QUERIES: dict[str, Query] = {
    "scan_raw": scan_raw,
    "scan_clean": scan_clean,
    "scan_fact": scan_fact,
    "fact_rows": fact_rows,
    "dedup_first": dedup_first,
    "reject_funnel": reject_funnel,
    "parse_timestamp": parse_timestamp,
    "parse_amount": parse_amount,
    "standardise_text": standardise_text,
    "initcap_region": initcap_region,
    "type_label": type_label,
    "time_dims": time_dims,
    "amount_bucket": amount_bucket,
    "total_debit": total_debit,
    "fee_rate": fee_rate,
    "p95_threshold": p95_threshold,
    "high_value_flag": high_value_flag,
    "rapid_succession": rapid_succession,
    "quality_report": quality_report_q,
    "summary_by_type": summary_by_type_q,
    "top_regions": top_regions_q,
    "audit_row": audit_row,
    "stg_transactions": stg_q,
    "mart_daily": mart_daily,
    "mart_operator": mart_operator,
    "mart_region": mart_region,
    "mart_high_value": mart_high_value,
    "market_share": market_share,
    "peak_hour": peak_hour,
    "risk_level": risk_level,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_accepted_operator": dq_accepted_operator,
    "dq_accepted_status": dq_accepted_status,
    "dq_type_labels": dq_type_labels,
    "dq_positive_amount": dq_positive_amount,
    "dq_total_debit": dq_total_debit,
    "dq_report_bounds": dq_report_bounds,
    "dq_unique_dirty": dq_unique_dirty,
    "dq_accepted_operator_dirty": dq_accepted_operator_dirty,
    "dq_accepted_status_dirty": dq_accepted_status_dirty,
    "dq_type_labels_dirty": dq_type_labels_dirty,
    "dq_positive_amount_dirty": dq_positive_amount_dirty,
    "dq_total_debit_dirty": dq_total_debit_dirty,
    "dq_report_bounds_dirty": dq_report_bounds_dirty,
    "dirty_profile": dirty_profile,
    "distinct_operators": distinct_operators,
    "fact_upsert": fact_upsert,
    "fact_publish": fact_publish,
    "mart_daily_incremental": mart_daily_incremental,
    "mart_operator_incremental": mart_operator_incremental,
    "mart_region_incremental": mart_region_incremental,
    "mart_high_value_incremental": mart_high_value_incremental,
    "subscriber_counts": subscriber_counts,
    "partition_slice": partition_slice,
    "fraud_alerts": fraud_alerts,
    "metrics_totals": metrics_totals,
    "metrics_by_key": metrics_by_key,
    "metrics_snapshot": metrics_snapshot,
    "csv_funnel": csv_funnel,
    "csv_scan": csv_scan,
    "stream_scan": stream_scan,
    "stream_log": stream_log,
    "stream_rapid": stream_rapid,
    "stream_alerts": stream_alerts,
    "stream_alert_csv": stream_alert_csv,
    "stream_metrics": stream_metrics,
    "stream_snapshots": stream_snapshots,
    "stream_throughput": stream_throughput,
}
