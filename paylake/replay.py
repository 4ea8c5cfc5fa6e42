"""Support for the registered stream queries and their tests: feeds a static
frame to a file source piece by piece, as a live topic would fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.session import materialize_at, release
from paylake.streaming.fraud import END_MARK


def offset_ranges(events: DataFrame, parts: int) -> list[DataFrame]:
    """``events`` split into ``parts`` consecutive offset ranges (only the
    min and max offset reach the driver)."""
    bounds = events.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return []
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = max(1, (hi - lo + parts) // parts)
    return [events.where((F.col("offset") >= lo + i * step) & (F.col("offset") < lo + (i + 1) * step))
            for i in range(parts)]


def range_size(events: DataFrame, parts: int) -> int:
    """Offsets in each of :func:`offset_ranges`: how far an event of one can lie behind another."""
    bounds = events.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    return 1 if bounds["lo"] is None else max(1, (int(bounds["hi"]) - int(bounds["lo"]) + parts) // parts)


def end_mark(events: DataFrame, after: int) -> DataFrame:
    """One event that is none, ``after`` offsets behind the last one."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name not in ("event_type", "offset")]
    last = events.agg((F.coalesce(F.max("offset"), F.lit(0)) + F.lit(after)).alias("offset"))
    return last.select(F.lit(END_MARK).alias("event_type"), "offset", *empty).select(*events.columns)


def _dealt(part: DataFrame) -> DataFrame:
    """``part`` over all cores: a range's rows may lie in few of the files."""
    cores = part.sparkSession.sparkContext.defaultParallelism
    return part.repartition(max(cores, part.rdd.getNumPartitions()), "offset")


def replay_in_order(events: DataFrame, path: str, parts: int, drain_once, reorder: int | None = None, drain_end=None) -> None:
    """Feed ``events`` to a file source at ``path`` the way a live topic
    fills: append one offset range (written in parallel, many files), then
    call ``drain_once()`` to run the stream until it has caught up, and so
    on. Every run after the first restarts from the query's checkpoint.

    ``events`` are derived once, into a folder that the ranges are taken from. A range is one
    micro-batch or, above the source's limit, several, over which its offsets may lie in any order;
    with ``reorder`` (for a query that reorders so far) an end mark follows the last range, and
    ``drain_end()`` (``drain_once()`` by default)."""
    staged, at = materialize_at(events, "replay")
    for part in offset_ranges(staged, parts):
        _dealt(part).sortWithinPartitions("offset").write.mode("append").parquet(path)
        drain_once()
    if reorder is not None:
        end_mark(staged, reorder + 1).coalesce(1).write.mode("append").parquet(path)
        (drain_end or drain_once)()
    release(events.sparkSession, at)
