"""Fact-table projection, key upsert, partition-scoped publication and audit rows."""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators import keyindex as K
from paylake.operators import versions as V
from paylake.schemas import AUDIT, FACT, FACT_COLUMNS
from paylake.session import materialize_at, stage_scope

KEY = "transaction_id"


def fact_rows(clean: DataFrame, loaded_at: bool = False) -> DataFrame:
    """The flagged clean frame in fact column order and fact types.

    ``time_since_last_txn_sec`` is rounded half up to cents of a second; its type
    holds any gap between two timestamps.
    """
    types = {f.name: f.dataType for f in FACT.fields}
    cols = []
    for c in FACT_COLUMNS:
        col = F.col(c)
        if c == "time_since_last_txn_sec":
            col = col.cast(types[c])
        elif c in ("txn_hour", "txn_month", "txn_quarter"):
            col = col.cast("int")
        cols.append(col.alias(c))
    if loaded_at:
        cols.append(F.current_timestamp().alias("loaded_at"))
    return clean.select(*cols)


def upsert(existing: DataFrame, incoming: DataFrame, key: str = KEY,
           update_cols: tuple = ("status",), stamp: str | None = None) -> DataFrame:
    """Insert new keys; for keys already present update only ``update_cols``
    (and ``stamp``, e.g. ``loaded_at``, to the current time).

    One full outer join on the key. Incoming keys are unique (de-duplicated
    upstream); amounts, timestamps and flags of existing rows never change.
    """
    cols = existing.columns
    e = existing.alias("e")
    i = incoming.select(*cols).alias("i")
    joined = e.join(i, F.col(f"e.{key}") == F.col(f"i.{key}"), "full_outer")
    matched = F.col(f"e.{key}").isNotNull() & F.col(f"i.{key}").isNotNull()
    in_existing = F.col(f"e.{key}").isNotNull()
    out = []
    for c in cols:
        if c in update_cols:
            expr = F.when(F.col(f"i.{key}").isNotNull(), F.col(f"i.{c}")).otherwise(F.col(f"e.{c}"))
        elif stamp is not None and c == stamp:
            expr = F.when(matched, F.current_timestamp().cast(existing.schema[c].dataType)) \
                    .when(in_existing, F.col(f"e.{c}")).otherwise(F.col(f"i.{c}"))
        else:
            expr = F.when(in_existing, F.col(f"e.{c}")).otherwise(F.col(f"i.{c}"))
        out.append(expr.alias(c))
    return joined.select(*out)


# --- publication ------------------------------------------------------------
#
# A version of the table (see :mod:`paylake.operators.versions`) says for every date which
# folder ``data/run=<id>/txn_date=<d>`` holds it, and which folders its key index has. Readers
# see all of a publication or nothing of it, and a reader of an older version is not disturbed.

NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def create_fact(spark: SparkSession, root: str) -> None:
    """The empty table, if there is none: version 0, without dates."""
    if not V.versions(spark, root):
        with contextlib.suppress(V.CommitConflict):  # created meanwhile
            V.commit(spark, root, 0, {"dates": {}, "index": [], "buckets": K.BUCKETS})


def read_fact(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table's last (or the given) version; empty, with its schema, before the first."""
    state = V.last_version(spark, root)[1] if version is None else V.read_version(spark, root, version)
    return read_dates(spark, root, state.get("dates", {}))


def read_dates(spark: SparkSession, root: str, held: dict[str, str]) -> DataFrame:
    """The rows of some dates; ``held``: date -> folder."""
    if not held:
        return spark.createDataFrame([], FACT)
    data = f"{root.rstrip('/')}/data"
    paths = [f"{data}/{folder}/txn_date={d}" for d, folder in sorted(held.items())]
    return spark.read.schema(FACT).option("basePath", data).parquet(*paths).select(*[f.name for f in FACT.fields])


def write_by_date(df: DataFrame, path: str) -> None:
    """Parquet partitioned by ``txn_date``. Rows are dealt by date first, so a date's
    files follow its size: a large date is split at the advisory partition size, small
    ones share a task."""
    df.hint("rebalance", "txn_date").write.mode("overwrite").partitionBy("txn_date").parquet(path)


@dataclass
class Publication:
    """What a publication has written, in folders that no version names yet."""
    root: str
    version: int             # the version it is to become
    state: dict              # that version's content
    touched: list[str]       # the dates it writes
    folders: list[str]       # what it wrote


def stage_publication(spark: SparkSession, root: str, incoming: DataFrame, buckets: int = K.BUCKETS) -> Publication:
    """Write the upsert of ``incoming`` (fact rows with ``loaded_at``, unique ids) into the last version of
    the table beside it, invisible to readers until :func:`commit_publication`.

    Stored keys are matched by the bucketed index, without shuffling them or reading the
    fact rows; only the dates with incoming or matched rows are merged and written, the
    others stay where they are. Dates are bounded by the calendar, so their list
    passes the driver.
    """
    root, run = root.rstrip("/"), f"run={uuid.uuid4().hex}"
    base, state = V.last_version(spark, root)
    held, index = dict(state.get("dates", {})), list(state.get("index", []))
    buckets = state.get("buckets", buckets)
    with stage_scope(spark):
        incoming, _ = materialize_at(incoming.select(*[f.name for f in FACT.fields]), "fact-incoming")
        matched, _ = materialize_at(K.find(spark, root, index, incoming, KEY, buckets), "fact-matched")
        touched = sorted({NO_DATE if r.txn_date is None else str(r.txn_date)
                          for r in incoming.select("txn_date").union(matched.select("txn_date")).distinct().collect()})
        before = {d: held[d] for d in touched if d in held}
        done = Publication(root, 0 if base is None else base + 1, {}, touched, [f"{root}/data/{run}"])
        try:
            merged = upsert(read_dates(spark, root, before), incoming, stamp="loaded_at") if before else incoming
            write_by_date(merged, done.folders[0])
            new = incoming.select(KEY, "txn_date")
            if index:
                new = new.join(matched.select(KEY), KEY, "left_anti")
            if len(index) >= K.COMPACT:
                for name in index:
                    new = new.unionByName(K.open_folder(spark, root, name, KEY, buckets))
                index = []
            index.append(K.write_folder(new, root, KEY, buckets))
            done.folders.append(f"{root}/index/{index[-1]}")
        except BaseException:
            discard(spark, done)
            raise
        finally:
            K.close_folders(spark, root, state.get("index", []))
    done.state = {"dates": held | dict.fromkeys(touched, run), "index": index, "buckets": buckets}
    return done


def discard(spark: SparkSession, publication: Publication) -> None:
    """Delete what a publication wrote that was not committed."""
    for folder in publication.folders:
        V.delete(spark, folder)


def commit_publication(spark: SparkSession, publication: Publication) -> None:
    """Make it the next version. If another writer was faster, what was written is deleted and
    :class:`~paylake.operators.versions.CommitConflict` raised; the table is as the other left it."""
    try:
        V.commit(spark, publication.root, publication.version, publication.state)
    except BaseException:
        discard(spark, publication)
        raise


def publish_fact(spark: SparkSession, root: str, incoming: DataFrame, retries: int = 0, buckets: int = K.BUCKETS) -> int:
    """Upsert ``incoming`` into the fact table at ``root`` as its next version; returns
    the number of date partitions written. See :func:`stage_publication`.

    A conflict with another writer is raised after ``retries`` more attempts, each of which
    merges anew with the version that won. Running a batch again gives the same table but
    for ``loaded_at``. With a MERGE-capable table format, ``MERGE INTO`` replaces this.
    """
    for left in range(retries, -1, -1):
        staged = stage_publication(spark, root, incoming, buckets)
        try:
            commit_publication(spark, staged)
            return len(staged.touched)
        except V.CommitConflict:
            if not left:
                raise


# --- audit --------------------------------------------------------------------

def create_audit(spark: SparkSession, path: str, table: str | None = None) -> None:
    """The audit table with its schema, if there is none; ``table``: also by this name in the catalog."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in AUDIT.fields)
    if not V.exists(spark, path):
        spark.createDataFrame([], AUDIT).write.mode("append").partitionBy("run_id").parquet(path)
    if table:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet PARTITIONED BY (run_id) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row for each run; empty, with its schema, before the first."""
    if not V.exists(spark, path):
        return spark.createDataFrame([], AUDIT)
    return spark.read.schema(AUDIT).parquet(path).select(*[f.name for f in AUDIT.fields])


def audit_row(spark: SparkSession, report: DataFrame, run_id: str, partitions_written: int | None = None) -> DataFrame:
    """The audit record of a run (built from the one-row quality report),
    including the completion fields: run date, records loaded, status."""
    issues = F.to_json(F.col("issues"))
    return report.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("run_timestamp"),
        F.current_date().alias("run_date"),
        F.lit("SUCCESS").alias("status"),
        F.lit(partitions_written).cast("long").alias("partitions_written"),
        F.col("raw_count").cast("long").alias("raw_count"),
        F.col("clean_count").cast("long").alias("clean_count"),
        F.col("high_value_flagged").cast("long").alias("high_value_flagged"),
        F.col("rapid_succession_flagged").cast("long").alias("rapid_succession_flagged"),
        F.col("success_rate_pct").cast("double").alias("success_rate_pct"),
        issues.alias("issues"),
    )


def append_audit(audit: DataFrame, path: str) -> None:
    """Write the audit row of its run; written only after the fact partitions are published.

    The table is partitioned by ``run_id`` and only the run's own partition is written, so a
    run that is repeated leaves one row."""
    (audit.select(*[f.name for f in AUDIT.fields]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))


def export_csv(df: DataFrame, path: str) -> None:
    """Explicit CSV export of a frame (headered, one folder of part files).

    Arrays are not representable in CSV: join them to text first."""
    df.write.mode("errorifexists").option("header", True).csv(path)
