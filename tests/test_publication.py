"""Publications beside another writer, the key index, first tables, audit rows and marts that follow."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame
from paylake.operators import clean as C
from paylake.operators import fact as FT
from paylake.operators import keyindex as K
from paylake.operators import versions as V
from paylake.plans import incremental as I
from paylake.plans import marts as M
from paylake.plans.batch import run_batch, transform
from paylake.plans.staging import stg_transactions
from paylake.session import materialize, stage_root


def _raw(spark, n=40, days=4):
    rows = [(i, f"T{i}", f"2024-01-0{1 + i % days} 00:{i:02d}:00", f"S{i % 5}", f"{10 + i}.00", "SUCCESS", "ASIA", "0.1") for i in range(n)]
    return raw_frame(spark, rows)


def _fact(spark, **options):
    return FT.fact_rows(transform(_raw(spark, **options)).clean, loaded_at=True)


def _ids(df):
    return sorted(r.transaction_id for r in df.select("transaction_id").collect())


def _files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_a_stored_list_of_repeated_ids_replaces_the_window(spark):
    rows = [(i, f"T{i % 50}" if i % 7 else None, "2024-01-01 00:00:00", f"S{i}", str(i), "SUCCESS", "ASIA", "0.1") for i in range(300)]
    rows += [(300 + i, "HOT", "bad" if i == 0 else "2024-01-01 00:00:00", f"H{i}", "1", "SUCCESS", "ASIA", "0") for i in range(500)]
    raw = raw_frame(spark, rows)
    repeated = materialize(C.repeated_ids(raw), "repeated-ids")
    two = C.dedup_first(raw, repeated=repeated)
    assert sorted(two.collect(), key=str) == sorted(C.dedup_first(raw).collect(), key=str)
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "Sort" not in plan and "hashpartitioning" not in plan
    lazy, stored = transform(raw), transform(raw, stage=True)
    assert sorted(lazy.funnel.collect()) == sorted(stored.funnel.collect())


def test_the_loser_of_a_race_leaves_nothing(spark):
    root = tempfile.mkdtemp(prefix="paylake-race-") + "/fact"
    fact = _fact(spark)
    first = FT.stage_publication(spark, root, fact.where("txn_date = '2024-01-01'"))
    second = FT.stage_publication(spark, root, fact.where("txn_date < '2024-01-04'"))
    assert FT.read_fact(spark, root).count() == 0  # staged rows are invisible
    FT.commit_publication(spark, first)
    won, files = FT.read_fact(spark, root).collect(), _files(first.folders[0])
    with pytest.raises(V.CommitConflict):
        FT.commit_publication(spark, second)
    assert FT.read_fact(spark, root).collect() == won and len(won) == 10
    assert _files(root + "/data") == files and not any(os.path.exists(x) for x in second.folders)
    assert V.versions(spark, root) == [0]


def test_a_conflict_is_merged_again(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="paylake-retry-") + "/fact"
    fact, stage = _fact(spark), FT.stage_publication
    state = {"raced": False}

    def staged_then_overtaken(*args):
        out = stage(*args)
        if not state["raced"]:
            state["raced"] = True
            FT.commit_publication(spark, stage(spark, root, fact.where("txn_date = '2024-01-01'").withColumn("status", F.lit("FAILED"))))
        return out

    monkeypatch.setattr(FT, "stage_publication", staged_then_overtaken)
    later = fact.where("txn_date < '2024-01-03'")
    with pytest.raises(V.CommitConflict):
        FT.publish_fact(spark, root, later)
    state["raced"] = False
    assert FT.publish_fact(spark, root, later, retries=1) == 2
    got = FT.read_fact(spark, root)
    assert got.count() == 20 and got.where("status = 'FAILED'").count() == 0


def test_a_failed_publication_leaves_no_files(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="paylake-fail-") + "/fact"
    fact = _fact(spark)
    FT.publish_fact(spark, root, fact)
    before, staged = _files(root), set(os.listdir(stage_root(spark).removeprefix("file:")))
    monkeypatch.setattr(K, "write_folder", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        FT.publish_fact(spark, root, fact)
    assert _files(root) == before and set(os.listdir(stage_root(spark).removeprefix("file:"))) == staged


def test_stored_keys_are_matched_where_they_lie(spark):
    root = tempfile.mkdtemp(prefix="paylake-keys-") + "/fact"
    fact = _fact(spark)
    for day in ("01", "02", "03"):
        FT.publish_fact(spark, root, fact.where(f"txn_date = '2024-01-{day}'"))
    state = V.last_version(spark, root)[1]
    batch = spark.createDataFrame([(f"T{i}",) for i in (0, 1, 5, 99)], "transaction_id string")
    found = K.find(spark, root, state["index"], batch, "transaction_id", state["buckets"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert len(scans) == len(state["index"]) == 3 and all("Bucketed: true" in x for x in scans)
    # Whatever is exchanged comes from the batch: no scan lies below an exchange.
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = plan.split("\n")
    for k, line in enumerate(lines):
        if "Exchange" in line:
            below = []
            for x in lines[k + 1:]:
                if depth(x) <= depth(line):
                    break
                below.append(x)
            assert not any("FileScan" in x for x in below)
    assert sorted((r.transaction_id, r.txn_date.day) for r in found.collect()) == [("T0", 1), ("T1", 2), ("T5", 2)]


def test_the_index_is_compacted(spark, monkeypatch):
    monkeypatch.setattr(K, "COMPACT", 2)
    root = tempfile.mkdtemp(prefix="paylake-compact-") + "/fact"
    fact, sizes = _fact(spark), []
    for day in ("01", "02", "03", "04"):
        FT.publish_fact(spark, root, fact.where(f"txn_date = '2024-01-{day}'"))
        sizes.append(len(V.last_version(spark, root)[1]["index"]))
    assert sizes == [1, 2, 1, 2]
    # an update of a row of the first day finds it, whatever date the update has
    moved = fact.where("transaction_id = 'T0'").withColumn("txn_date", F.to_date(F.lit("2024-01-03"))).withColumn("status", F.lit("REVERSED"))
    FT.publish_fact(spark, root, moved)
    got = FT.read_fact(spark, root)
    assert got.count() == 40
    assert [(r.txn_date.day, r.status) for r in got.where("transaction_id = 'T0'").collect()] == [(1, "REVERSED")]


def test_tables_exist_before_the_first_run(spark):
    out = tempfile.mkdtemp(prefix="paylake-create-")
    for _ in range(2):
        FT.create_fact(spark, out + "/fact")
        FT.create_audit(spark, out + "/audit", "audit_log")
    assert FT.read_fact(spark, out + "/fact").schema == FT.FACT or FT.read_fact(spark, out + "/fact").columns == [f.name for f in FT.FACT.fields]
    assert FT.read_fact(spark, out + "/fact").count() == 0 and FT.read_audit(spark, out + "/audit").count() == 0
    assert set(spark.table("audit_log").columns) == {f.name for f in FT.AUDIT.fields} and spark.table("audit_log").count() == 0
    assert FT.read_fact(spark, out + "/nowhere").count() == 0 and FT.read_audit(spark, out + "/nowhere").count() == 0
    run_batch(spark, _raw(spark), out, "first")
    FT.create_fact(spark, out + "/fact")
    assert FT.read_fact(spark, out + "/fact").count() == 40 and FT.read_audit(spark, out + "/audit").first().run_id == "first"
    spark.sql("DROP TABLE audit_log")


def test_a_repeated_run_leaves_one_audit_row(spark):
    out = tempfile.mkdtemp(prefix="paylake-audit-")
    for run in ("2024-01-31", "2024-01-31", "later run/1"):
        run_batch(spark, _raw(spark), out, run)
    audit = FT.read_audit(spark, out + "/audit").collect()
    assert sorted(r.run_id for r in audit) == ["2024-01-31", "later run/1"]
    assert all(r.raw_count == 40 and r.status == "SUCCESS" for r in audit)
    assert FT.read_fact(spark, out + "/fact").count() == 40


MARTS = {"mart_daily_revenue": M.mart_daily, "mart_operator_performance": M.mart_operator, "mart_region_summary": M.mart_region,
         I.HIGH_VALUE: M.mart_high_value}


def _same_as_rebuilt(spark, root):
    stg, folder = stg_transactions(FT.read_fact(spark, root + "/fact")), I.MartFolder(spark, root + "/marts")
    for name, build in MARTS.items():
        assert [r.asDict() for r in folder.mart(name).collect()] == [r.asDict() for r in build(stg).collect()], name
    return folder


def test_marts_follow_the_touched_dates(spark):
    root = tempfile.mkdtemp(prefix="paylake-follow-")
    fact = _fact(spark)
    FT.publish_fact(spark, root + "/fact", fact)
    with pytest.raises(LookupError):
        I.MartFolder(spark, root + "/marts").mart("mart_daily_revenue")
    assert I.refresh_marts(spark, root + "/fact", root + "/marts") == 4
    assert I.refresh_marts(spark, root + "/fact", root + "/marts") == 0
    old = _same_as_rebuilt(spark, root)
    update = fact.where("transaction_id = 'T1'").withColumn("status", F.lit("REVERSED"))
    new = (fact.where("transaction_id = 'T2'").withColumn("transaction_id", F.lit("T999")).withColumn("sender_msisdn", F.lit("NEW"))
           .withColumn("txn_date", F.to_date(F.lit("2024-01-09"))))
    dropped = fact.where("transaction_id = 'T6'").withColumn("transaction_id", F.lit("T777")).withColumn("status", F.lit("ODD")) \
        .withColumn("txn_date", F.to_date(F.lit("2024-01-08")))  # no staging row on that day
    FT.publish_fact(spark, root + "/fact", update.unionByName(new).unionByName(dropped))
    assert I.refresh_marts(spark, root + "/fact", root + "/marts") == 3
    folder = _same_as_rebuilt(spark, root)
    moved = {d for d, run in folder.state["runs"].items() if run != old.state["run"]}
    assert moved == {"2024-01-02", "2024-01-08", "2024-01-09"}
    assert folder.state["subscribers"] == old.state["subscribers"] + 1
    # the marts of the refresh before are where they were
    assert old.mart("mart_daily_revenue").count() == 4


def test_marts_of_an_empty_table(spark):
    root = tempfile.mkdtemp(prefix="paylake-empty-")
    FT.create_fact(spark, root + "/fact")
    assert I.refresh_marts(spark, root + "/fact", root + "/marts") == 0
    folder = I.MartFolder(spark, root + "/marts")
    assert folder.version == 0 and all(folder.mart(name).count() == 0 for name in MARTS)
    assert folder.subscriber_counts().count() == 0


def test_a_lost_refresh_leaves_nothing(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="paylake-lost-")
    FT.publish_fact(spark, root + "/fact", _fact(spark))
    I.refresh_marts(spark, root + "/fact", root + "/marts")
    FT.publish_fact(spark, root + "/fact", _fact(spark).where("transaction_id = 'T1'"))
    before = _files(root + "/marts")

    def taken(*args):
        raise V.CommitConflict("taken")

    monkeypatch.setattr(V, "commit", taken)
    with pytest.raises(V.CommitConflict):
        I.refresh_marts(spark, root + "/fact", root + "/marts", retries=1)
    assert _files(root + "/marts") == before


def test_numbers_have_no_gaps_and_sketches_stay_close(spark):
    values = spark.range(20_000).select(F.concat(F.lit("s"), F.col("id")).alias("value")).repartition(7)
    ids = I.numbered(values, 101)
    assert ids.agg(F.min("id"), F.max("id"), F.count_distinct("id"), F.count_distinct("value")).first() == (101, 20_100, 20_000, 20_000)
    rows = values.crossJoin(spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string")) \
        .where("d = '2024-01-01' OR value < 's5'").select(F.to_date("d").alias(I.DATE), F.lit("x").alias("dimension"),
                                                          F.lit(None).cast("string").alias("member"), "value")
    assert I.distinct_counts(I.bitmaps(rows, ids)).first().n == 20_000
    assert abs(I.sketch_counts(I.sketches(rows)).first().estimate - 20_000) <= 20_000 * 0.05
