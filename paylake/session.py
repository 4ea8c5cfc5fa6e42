"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "paylake", extra: dict | None = None) -> SparkSession:
    """A session with the settings the engine relies on (UTC, AQE, RocksDB state)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment (a shared filesystem): a
    missing setting is an error there, since each executor would write to its
    own disk. Only with a ``local`` master -- tests and trials -- a private folder
    is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="paylake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_ROOTS: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """This application's own folder under the shared checkpoint folder; whatever is
    staged in it and not released earlier goes when the application's driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = f"{checkpoint_dir(spark).rstrip('/')}/paylake-{app}/"
        atexit.register(_drop, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), _ROOTS[app])
    return _ROOTS[app]


def _drop(jvm, conf, root: str) -> None:
    try:
        p = jvm.org.apache.hadoop.fs.Path(root)
        p.getFileSystem(conf).delete(p, True)
    except Exception:  # the JVM may have ended first; the folder then stays
        pass


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder written by :func:`materialize_at` (shared storage, via
    the Hadoop filesystem). Refuses any path outside the staging root. Only
    for folders no lazy frame will read again."""
    if not path.startswith(stage_root(spark)):
        raise ValueError(f"not a staged folder: {path}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _STAGED.paths:
        _STAGED.paths.remove(path)


class _Staged(threading.local):
    """Folders staged and not yet released, for each thread: a scope releases its own thread's only."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_STAGED = _Staged()


@contextmanager
def stage_scope(spark: SparkSession):
    """Folders staged inside are released at the end, but for those given to the function
    that the scope yields. For steps whose result is written before the scope ends."""
    before, kept = set(_STAGED.paths), set()
    try:
        yield kept.add
    finally:
        for path in [p for p in _STAGED.paths if p not in before and p not in kept]:
            release(spark, path)


def materialize_at(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder; return the
    frame that reads it back and the folder.

    Cuts the lineage (a lost executor recomputes from these files, not from
    the source), and later branches read only the columns they need with
    predicate pushdown -- unlike ``DataFrame.checkpoint()``, whose row files
    cannot be pruned.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    _STAGED.paths.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df, name: str):
    """:func:`materialize_at` without the folder."""
    return materialize_at(df, name)[0]


def ensure_streaming_conf(spark: SparkSession) -> None:
    """Stateful stream operators need the RocksDB state store provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
