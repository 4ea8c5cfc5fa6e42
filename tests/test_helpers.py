"""Helpers: stream replay ranges, sources, data-quality rules, staging folders."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from paylake.operators import quality as Q
from paylake.sources.fixtures import live_events
from paylake.sources.tables import table
from paylake.replay import offset_ranges


def test_offset_ranges_cover_every_event_once(spark):
    ev = live_events(spark, SF_SMALL)
    parts = offset_ranges(ev, 4)
    counts = [p.count() for p in parts]
    assert len(parts) == 4 and sum(counts) == ev.count() and min(counts) > 0
    bounds = [p.agg(F.min("offset"), F.max("offset")).first() for p in parts]
    assert all(bounds[i][1] < bounds[i + 1][0] for i in range(3))


def test_table_sees_rows_appended_later(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 5
    spark.range(7).write.mode("append").parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 12


def test_large_ids_keep_their_digits(spark, tmp_path):
    from paylake.sources.fixtures import live_events, raw_feed
    from paylake.operators.clean import classify
    ids = [100_000_000, 100_000_009, 1_000_000_019, 1_000_000_126, 2_000_000_145, 10_000_000_000_016]
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(1).drop("event_id", "user_id")
    ev = ev.crossJoin(spark.createDataFrame([(i, 10_000_000 + i % 97) for i in ids], "event_id long, user_id long"))
    ev.write.parquet(str(tmp_path / "events.parquet"))
    raw = raw_feed(spark, str(tmp_path))
    copies = sum(i % 107 == 19 for i in ids)
    assert raw.select("ingest_seq").distinct().count() == raw.count() == len(ids) + copies
    found = {r.transaction_id for r in classify(raw).collect()}
    assert found == {f"TXN{i}" for i in ids if i % 101 != 7}
    live = live_events(spark, str(tmp_path)).collect()
    assert {r.transaction_id for r in live} == {f"TXN-LIVE-{i + 1}" for i in ids}


def test_staging_needs_a_shared_folder_on_a_cluster(spark):
    import pytest
    from types import SimpleNamespace
    from paylake.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: None)
    for master, ok in (("spark://host:7077", False), ("yarn", False), ("local-cluster[2,1,1024]", False), ("local[4]", True)):
        made = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, getConf=lambda: conf, setCheckpointDir=made.append)
        fake = SimpleNamespace(sparkContext=sc, conf=conf)
        if ok:
            assert checkpoint_dir(fake) == made[0] and os.path.isdir(made[0])
        else:
            with pytest.raises(RuntimeError):
                checkpoint_dir(fake)


def test_building_a_query_starts_no_job_and_leaves_no_folder(spark):
    from paylake.registry import QUERIES
    from paylake.session import stage_root
    root = stage_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        for k in ("reject_funnel", "quality_report", "mart_operator", "time_dims", "dq_unique", "audit_row", "fact_upsert"):
            QUERIES[k](spark, SF_SMALL)
        listing = len(tracker.getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # schema reading of the Parquet inputs is the only work
    assert listing <= 4 * 7
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before


def test_reject_funnel_reads_only_what_it_needs(spark):
    from paylake.registry import QUERIES
    plan = QUERIES["reject_funnel"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan and "r_name" not in plan and plan.count("Window [") == 1


def test_quality_rules_report_violations(spark):
    df = spark.createDataFrame(
        [("A", "MTN", "SUCCESS", 10.0), ("A", "ORANGE", "LOST", None), (None, "MTN", "FAILED", -1.0)],
        "transaction_id string, operator string, transaction_status string, transaction_amount_ghs double")
    assert [(r.transaction_id, r.occurrences) for r in Q.duplicate_keys(df).collect()] == [("A", 2)]
    assert {(r.operator, r.rows) for r in Q.bad_operators(df).collect()} == {("ORANGE", 1)}
    assert {(r.transaction_status, r.rows) for r in Q.bad_statuses(df).collect()} == {("LOST", 1)}
    nulls = {r.column_name: r.null_rows for r in Q.null_counts(df, ["transaction_id", "transaction_amount_ghs"]).collect()}
    assert nulls == {"transaction_id": 1, "transaction_amount_ghs": 1}
    assert Q.non_positive_amounts(df, "transaction_amount_ghs").count() == 1


def test_stage_scope_releases_all_but_the_kept(spark):
    from paylake.session import materialize_at, stage_scope
    outside, path0 = materialize_at(spark.range(3), "scope")
    with stage_scope(spark) as keep:
        _, path1 = materialize_at(spark.range(4), "scope")
        kept, path2 = materialize_at(spark.range(5), "scope")
        keep(path2)
    exists = lambda p: os.path.exists(p.removeprefix("file:"))
    assert (outside.count(), kept.count()) == (3, 5) and exists(path0) and not exists(path1)
