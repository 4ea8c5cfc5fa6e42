"""Structured Streaming jobs: source, fraud alerts, metrics, event log.

Each job is ``readStream -> transformations -> writeStream`` with its own
checkpoint, so it restarts exactly where it stopped. ``trigger`` defaults
to ``availableNow`` (drain what is there, then stop); pass
``{"processingTime": "10 seconds"}`` for a periodic live run.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from paylake.schemas import EVENT
from paylake.session import ensure_streaming_conf, stage_root
from paylake.streaming import fraud as FR
from paylake.streaming import metrics as MT

DEFAULT_TRIGGER = {"availableNow": True}
#: Input of one micro-batch by default; what is over it comes in the next ones.
BYTES_PER_BATCH = 1 << 30
#: State partitions of a query on a small cluster.
STATE_PARTITIONS = 12


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the application's part of the shared checkpoint folder."""
    import uuid
    return f"{stage_root(spark)}{name}-{uuid.uuid4().hex}"


def read_events(spark: SparkSession, path: str, files_per_batch: int | None = None,
                fmt: str = "parquet", bytes_per_batch: int | None = None) -> DataFrame:
    """Streaming event source over files (typed schema, no inference).

    A micro-batch takes ``bytes_per_batch`` (``BYTES_PER_BATCH``) of new files at most (or
    ``files_per_batch`` files), so that its size does not follow the backlog; all
    files are drained, over as many batches as it takes. For a Kafka topic see :func:`read_kafka_events`; the downstream
    jobs are the same.
    """
    ensure_streaming_conf(spark)
    r = spark.readStream.schema(EVENT)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    else:
        r = r.option("maxBytesPerTrigger", bytes_per_batch or BYTES_PER_BATCH)
    return r.format(fmt).load(path)


def read_kafka_events(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Streaming events from a Kafka topic: JSON values parsed with the
    typed event schema (malformed JSON gives null fields, never an error).
    Needs the spark-sql-kafka package on the classpath (not available in
    this environment, so this path is untested here)."""
    ensure_streaming_conf(spark)
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic))
    for k, v in options.items():
        r = r.option(k, v)
    raw = r.load()
    return raw.select(F.from_json(F.col("value").cast("string"), EVENT).alias("e")).select("e.*")


def _live_only(mode: str, trigger) -> None:
    """A state with a time to live makes the engine run batches for ever, so that a query
    that is to drain its input and stop would never stop."""
    if mode == "bounded" and "processingTime" not in (trigger or DEFAULT_TRIGGER):
        raise ValueError("bounded state needs a periodic trigger, such as {'processingTime': '10 seconds'}")


def _trigger(w, trigger):
    return w.trigger(**(trigger or DEFAULT_TRIGGER))


_STARTING = threading.Lock()


def _start_stateful(spark: SparkSession, w, trigger) -> StreamingQuery:
    """Start a query with state. Its first start fixes the number of its state partitions, by the session's shuffle
    partitions. Each partition writes its files to the checkpoint in every micro-batch, be it empty or
    not, so a query gets no more of them than the cluster has cores (``STATE_PARTITIONS`` at least)."""
    key = "spark.sql.shuffle.partitions"
    with _STARTING:
        before = spark.conf.get(key)
        spark.conf.set(key, str(min(int(before), max(STATE_PARTITIONS, spark.sparkContext.defaultParallelism))))
        try:
            return _trigger(w, trigger).start()
        finally:
            spark.conf.set(key, before)


def start_alerts(events: DataFrame, out: str, ckpt: str, trigger=None, mode: str = "parity", reorder: int | None = None) -> StreamingQuery:
    """Fraud alerts appended to Parquet (exactly once via the checkpoint)."""
    _live_only(mode, trigger)
    w = FR.stream_alerts(events, mode, reorder).writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", ckpt).option("path", out)
    return _start_stateful(events.sparkSession, w, trigger)


def start_gaps(events: DataFrame, out: str, ckpt: str, trigger=None, mode: str = "parity", reorder: int | None = None) -> StreamingQuery:
    """Per-event gap since the sender's previous event (keyed state)."""
    _live_only(mode, trigger)
    w = FR.stream_gaps(events, mode, reorder=reorder).writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", ckpt).option("path", out)
    return _start_stateful(events.sparkSession, w, trigger)


def start_alert_csv(events: DataFrame, out: str, ckpt: str, trigger=None, reorder: int | None = None) -> StreamingQuery:
    """Alerts as CSV; the list of signals is joined with `` + ``."""
    alerts = FR.stream_alerts(events, reorder=reorder).select(
        "transaction_id", "amount_ghs", "operator", "region",
        F.array_join("alerts", " + ").alias("alerts"), "detected_at")
    w = alerts.writeStream.format("csv").option("header", True).outputMode("append") \
        .option("checkpointLocation", ckpt).option("path", out)
    return _start_stateful(events.sparkSession, w, trigger)


def start_log(events: DataFrame, out: str, ckpt: str, trigger=None) -> StreamingQuery:
    """Event log: one JSON object per line, every event as received."""
    w = events.writeStream.format("json").outputMode("append") \
        .option("checkpointLocation", ckpt).option("path", out)
    return _trigger(w, trigger).start()


def start_metrics(events: DataFrame, out: str, ckpt: str, trigger=None) -> StreamingQuery:
    """Running keyed sums (complete mode; state bounded by the key domain) and,
    for every trigger, a snapshot row: batch ``n`` writes the current sums to
    ``out/by_key/batch_id=n`` and its row to ``out/snapshots/batch_id=n``. A batch that
    is run again after a failure writes the same folders again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        keyed, row = (os.path.join(out, name, f"batch_id={batch_id}") for name in ("by_key", "snapshots"))
        batch.write.mode("overwrite").parquet(keyed)
        MT.snapshot_from(batch.sparkSession.read.schema(batch.schema).parquet(keyed)).write.mode("overwrite").parquet(row)

    w = MT.keyed_sums(events).writeStream.outputMode("complete").foreachBatch(write) \
        .option("checkpointLocation", ckpt)
    return _start_stateful(events.sparkSession, w, trigger)


def read_snapshots(spark: SparkSession, out: str) -> DataFrame:
    """One row per trigger of the metrics job, with its ``batch_id``."""
    return spark.read.parquet(os.path.join(out, "snapshots"))


def read_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The last trigger's snapshot row."""
    rows = read_snapshots(spark, out)
    last = rows.agg(F.max("batch_id").alias("n")).scalar()
    return rows.where(F.col("batch_id") == last).drop("batch_id")


def drain(queries) -> None:
    queries = queries if isinstance(queries, (list, tuple)) else [queries]
    try:
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
    finally:  # after a failure the others end too
        for q in queries:
            q.stop()


def progress_summary(q: StreamingQuery) -> dict:
    """Rows and throughput over the query's recent micro-batches (Spark keeps 100 of them by
    default); :class:`Throughput` counts whole runs."""
    ps = q.recentProgress
    return {
        "batches": len(ps),
        "input_rows": int(sum(p.numInputRows for p in ps)),
        "rows_per_sec": max([p.processedRowsPerSecond or 0.0 for p in ps] or [0.0]),
    }


#: Name of the metric that :func:`observed` adds.
OBSERVED = "throughput"


def observed(events: DataFrame) -> DataFrame:
    """``events`` with a count of them (end marks are none) reported for every micro-batch, once for each
    however often the plan reads the source."""
    return events.observe(OBSERVED, F.count_if(~F.col("event_type").eqNullSafe(FR.END_MARK)).alias("rows"))


class Throughput(StreamingQueryListener):
    """Exact rows and rates of every query of a session over its whole runs, however many
    micro-batches they have: each batch's report is added to a few sums per run and forgotten.

    Register with ``spark.streams.addListener``; reports of rows need :func:`observed`
    on the query's input. Restarts of a query are runs of the same ``id``; a batch that is
    run again after a failure counts once, by its number.
    """

    def __init__(self) -> None:
        self._runs: dict[str, dict] = {}
        self._done: set[str] = set()
        self._changed = threading.Condition()

    def _of(self, id_) -> dict:
        return self._runs.setdefault(str(id_), {"batches": 0, "input_rows": 0, "busy_ms": 0, "rows_per_sec": 0.0, "last": -1})

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._of(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = p.observedMetrics.get(OBSERVED)
        with self._changed:
            run = self._of(p.id)
            if p.batchId <= run["last"]:
                return
            n = int(row["rows"]) if row is not None else int(p.numInputRows)
            run["last"] = p.batchId
            run["batches"] += 1
            run["input_rows"] += n
            run["busy_ms"] += int(p.batchDuration)
            run["rows_per_sec"] = max(run["rows_per_sec"], n * 1000.0 / max(1, p.batchDuration))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._done.add(str(event.runId))
            self._changed.notify_all()

    def summary(self, q: StreamingQuery, timeout: float = 60.0) -> dict:
        """Batches, input rows, and rows a second at most and on average of the query, all its runs
        together. Waits until the report of a run that has ended has come."""
        with self._changed:
            if not q.isActive:
                self._changed.wait_for(lambda: str(q.runId) in self._done, timeout)
            run = dict(self._of(q.id))
        return {"batches": run["batches"], "input_rows": run["input_rows"], "rows_per_sec": run["rows_per_sec"],
                "mean_rows_per_sec": run["input_rows"] * 1000.0 / max(1, run["busy_ms"])}
