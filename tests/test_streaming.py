"""Streaming jobs over several micro-batches equal their batch twins."""

import time

from pyspark.sql import functions as F

from paylake.schemas import EVENT
from paylake.sources.fixtures import live_events
from paylake.streaming import fraud as FR
from paylake.replay import replay_in_order
from paylake.streaming import jobs as J
from paylake.streaming import metrics as MT

from conftest import SF_SMALL


def _event(offset, ts, sender="0240000001", amount=10.0, status="SUCCESS"):
    return ("TRANSACTION", "t", offset % 3, offset, ts, f"TXN-LIVE-{offset:08d}", sender, "0550000001",
            amount, 0.1, "P2P", "MTN", status, "Ashanti", amount >= 500)


def test_late_event_parity_mode_across_batches(spark):
    src = J.scratch(spark, "late-in")
    batches = [[_event(1, "2024-01-01T00:00:00")], [_event(2, "2024-01-01T00:01:40")],
               [_event(3, "2024-01-01T00:00:20")]]
    for b in batches:
        spark.createDataFrame(b, EVENT).coalesce(1).write.mode("append").parquet(src)
    out, ckpt = J.scratch(spark, "late-out"), J.scratch(spark, "late-ckpt")
    J.drain(J.start_gaps(J.read_events(spark, src, files_per_batch=1), out, ckpt))
    got = {r.offset: r.gap_sec for r in spark.read.parquet(out).collect()}
    assert got == {1: None, 2: 100.0, 3: -80.0}


def test_stream_restart_resumes_state(spark):
    src = J.scratch(spark, "restart-in")
    out, ckpt = J.scratch(spark, "restart-out"), J.scratch(spark, "restart-ckpt")
    spark.createDataFrame([_event(1, "2024-01-01T00:00:00")], EVENT).write.mode("append").parquet(src)
    J.drain(J.start_gaps(J.read_events(spark, src), out, ckpt))
    spark.createDataFrame([_event(2, "2024-01-01T00:00:05")], EVENT).write.mode("append").parquet(src)
    J.drain(J.start_gaps(J.read_events(spark, src), out, ckpt))
    got = {r.offset: r.gap_sec for r in spark.read.parquet(out).collect()}
    assert got == {1: None, 2: 5.0}


def test_stream_alerts_equal_batch_twin(spark):
    ev = live_events(spark, SF_SMALL)
    src = J.scratch(spark, "alerts-in")
    out, ckpt = J.scratch(spark, "alerts-out"), J.scratch(spark, "alerts-ckpt")
    runs = []

    def once():
        q = J.start_alerts(J.read_events(spark, src), out, ckpt)
        J.drain(q)
        runs.append(J.progress_summary(q))

    replay_in_order(ev, src, 3, once)
    assert len(runs) == 3 and sum(r["input_rows"] for r in runs) == ev.count()
    cols = ["transaction_id", F.array_join("alerts", " + ").alias("a")]
    stream = sorted(spark.read.parquet(out).select(*cols).collect())
    batch = sorted(FR.fraud_alerts(ev).select(*cols).collect())
    assert stream == batch and len(batch) > 0


def test_stream_metrics_snapshot_equals_batch(spark):
    ev = live_events(spark, SF_SMALL)
    src = J.scratch(spark, "metrics-in")
    out, ckpt = J.scratch(spark, "metrics-out"), J.scratch(spark, "metrics-ckpt")
    replay_in_order(ev, src, 2, lambda: J.drain(J.start_metrics(J.read_events(spark, src), out, ckpt)))
    assert J.read_snapshot(spark, out).collect() == MT.metrics_snapshot(ev).collect()


def test_snapshot_of_nothing(spark):
    empty = spark.createDataFrame([], EVENT)
    r = MT.metrics_snapshot(empty).first()
    assert r.total_transactions == 0 and r.success_rate_pct == 0.0
    assert r.top_operator == "N/A" and r.top_region == "N/A"


def test_partition_slice_is_round_robin(spark):
    ev = live_events(spark, SF_SMALL)
    counts = {r.queue_partition: r["count"] for r in FR.partition_slice(ev).groupBy("queue_partition").count().collect()}
    total = ev.count()
    assert sum(counts.values()) == total and max(counts.values()) - min(counts.values()) <= 1
    assert FR.partition_slice(ev, 0).where(F.pmod(F.col("offset") - 1, F.lit(3)) != 0).count() == 0


LIVE = {"processingTime": "1 second"}


def _run(spark, batches, start, mode):
    """One micro-batch for each of ``batches``; the sink folder. A bounded query runs on
    a periodic trigger until it has taken all rows."""
    src, out, ckpt = (J.scratch(spark, f"run-{x}") for x in ("in", "out", "ckpt"))
    for b in batches:
        spark.createDataFrame(b, EVENT).coalesce(1).write.mode("append").parquet(src)
    events = J.read_events(spark, src, files_per_batch=1)
    if mode == "parity":
        J.drain(start(events, out, ckpt))
        return out
    q = start(events, out, ckpt, trigger=LIVE, mode=mode)
    try:
        taken, until = {}, time.time() + 90
        while sum(taken.values()) < sum(map(len, batches)):
            assert time.time() < until and q.exception() is None
            taken.update({p.batchId: p.numInputRows for p in q.recentProgress})
            time.sleep(0.3)
    finally:
        q.stop()
    return out


def _gaps_over_batches(spark, batches, mode):
    return {r.offset: r.gap_sec for r in spark.read.parquet(_run(spark, batches, J.start_gaps, mode)).collect()}


def test_bounded_mode_refuses_to_drain(spark):
    import pytest
    with pytest.raises(ValueError, match="periodic"):
        J.start_alerts(None, "out", "ckpt", mode="bounded")


def test_late_events_are_judged_in_both_modes(spark):
    batches = [[_event(1, "2024-01-01T00:00:00")], [_event(2, "2024-01-01T00:01:40")],
               [_event(3, "2024-01-01T00:03:00")], [_event(4, "2024-01-01T00:00:20")]]
    for mode in ("parity", "bounded"):
        assert _gaps_over_batches(spark, batches, mode) == {1: None, 2: 100.0, 3: 80.0, 4: -160.0}


ODD = [[_event(1, "2024-01-01T00:00:00"), _event(2, "garbage", amount=600.0), _event(3, "2024-01-01T00:00:04")],
       [_event(4, "2024-01-01T00:00:05", sender=None, amount=900.0), _event(5, "2024-01-01T00:00:06", sender=None, amount=300.0, status="FAILED"),
        _event(6, None), _event(7, "2024-01-01T00:00:09"), _event(8, "2024-01-01T00:00:01", amount=5000.0, status="FAILED")]]


def _alerts_over_batches(spark, batches, mode):
    out = _run(spark, batches, J.start_alerts, mode)
    return sorted((r.transaction_id, tuple(r.alerts)) for r in spark.read.parquet(out).collect())


def test_null_senders_and_bad_times_equal_the_batch_twin(spark):
    batch = sorted((r.transaction_id, tuple(r.alerts))
                   for r in FR.fraud_alerts(spark.createDataFrame([e for b in ODD for e in b], EVENT)).collect())
    assert [t[-1] for t, _ in batch] == list("234578")
    assert dict(batch)["TXN-LIVE-00000002"] == ("HIGH_VALUE: GHS 600.00",)
    assert dict(batch)["TXN-LIVE-00000003"] == ("RAPID_SUCCESSION: 4.0s since last txn",)
    assert dict(batch)["TXN-LIVE-00000007"] == ("RAPID_SUCCESSION: 5.0s since last txn",)
    for mode in ("parity", "bounded"):
        assert _alerts_over_batches(spark, ODD, mode) == batch


def test_gaps_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        batches = [[_event(1, "2024-03-10T01:59:58")], [_event(2, "2024-03-10T02:30:03")], [_event(3, "2024-03-10T02:30:07")]]
        for mode in ("parity", "bounded"):
            assert _gaps_over_batches(spark, batches, mode) == {1: None, 2: 1805.0, 3: 4.0}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_snapshot_row_for_every_trigger(spark):
    src = J.scratch(spark, "snap-in")
    for k in range(3):
        spark.createDataFrame([_event(3 * k + i, "2024-01-01T00:00:00") for i in (1, 2, 3)], EVENT).coalesce(1).write.mode("append").parquet(src)
    out, ckpt = J.scratch(spark, "snap-out"), J.scratch(spark, "snap-ckpt")
    J.drain(J.start_metrics(J.read_events(spark, src, files_per_batch=1), out, ckpt))
    assert sorted((r.batch_id, r.total_transactions) for r in J.read_snapshots(spark, out).collect()) == [(0, 3), (1, 6), (2, 9)]
    assert J.read_snapshot(spark, out).first().total_transactions == 9
