"""Fraud signals on live events: high value, rapid succession, failed high.

Batch twin: :func:`fraud_alerts` on a static events frame (previous event
of the sender in arrival order via the skew-aware previous-value
operator). Stream: :func:`stream_gaps` keeps the sender's last event time
as keyed state (``transformWithStateInPandas``), then the same stateless
signal expressions build the alerts.

Every event is judged: one without a sender, or with a time that can't be read,
has no gap and leaves the state as it is, but its other signals count. A gap is
the time since the sender's last event whose time could be read.
"""

from __future__ import annotations

import sys
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from paylake.functions.calendar import epoch_micros
from paylake.functions.parse import parse_iso_timestamp
from paylake.functions.text import money_text, plain_fixed
from paylake.operators.sequence import previous_value
from paylake.schemas import (LIVE_FAILED_HIGH_GHS, LIVE_RAPID_GAP_SECONDS, PARTITION_COUNT)

# The stateful processors below run in Python workers (and in a driver-side
# pre-init runner) that may not have this package on their path: serialize
# this module's classes by value instead of by import reference.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_queue_partition(events: DataFrame) -> DataFrame:
    """``queue_partition = (offset - 1) mod 3``: the round-robin queue an event
    was appended to (the event's own ``partition`` field counts from 1)."""
    return events.withColumn("queue_partition", F.pmod(F.col("offset") - 1, F.lit(PARTITION_COUNT)).cast("int"))


def partition_slice(events: DataFrame, partition: int | None = None) -> DataFrame:
    """Events of one queue partition, or all events (a consumer group's view)."""
    ev = with_queue_partition(events)
    return ev if partition is None else ev.where(F.col("queue_partition") == partition)


def event_time(events: DataFrame) -> DataFrame:
    """``event_us``: the ISO ``timestamp`` text as wall-clock micros (null if it can't be
    read; a naive ISO time difference does not depend on a time zone)."""
    # parsed in a step of its own: the micros use the parsed time several times
    timed = events.withColumn("_time", parse_iso_timestamp(F.col("timestamp")))
    return timed.withColumn("event_us", epoch_micros(F.col("_time"))).drop("_time")


def alert_texts(amount: Column, status: Column, is_high_value: Column, gap_sec: Column) -> Column:
    """Array of the signals that fire, in signal order (empty when none)."""
    money = money_text(amount, 2)
    signals = F.array(
        F.when(is_high_value, F.concat(F.lit("HIGH_VALUE: GHS "), money)),
        F.when(gap_sec < LIVE_RAPID_GAP_SECONDS,
               F.concat(F.lit("RAPID_SUCCESSION: "), plain_fixed(gap_sec, 1), F.lit("s since last txn"))),
        F.when((status == "FAILED") & (amount > LIVE_FAILED_HIGH_GHS),
               F.concat(F.lit("FAILED_HIGH_AMOUNT: GHS "), money)),
    )
    return F.filter(signals, lambda x: x.isNotNull())


def _alerts(df: DataFrame) -> DataFrame:
    alerts = alert_texts(F.col("amount_ghs"), F.col("status"),
                         F.coalesce(F.col("is_high_value"), F.lit(False)), F.col("gap_sec"))
    return (df.withColumn("alerts", alerts).where(F.size("alerts") > 0)
            .select("transaction_id", "amount_ghs", "operator", "region", "alerts",
                    F.current_timestamp().alias("detected_at")))


def gaps(events: DataFrame, split_offsets: int = 1_000_000) -> DataFrame:
    """``gap_sec`` = seconds since the sender's previous event with a readable time, in
    arrival (offset) order; negative for an event older than its predecessor."""
    ev = event_time(events).withColumn("_sender", F.when(F.col("event_us").isNotNull(), F.col("sender_msisdn")))
    bucket = F.floor(F.col("offset") / F.lit(split_offsets))
    out = previous_value(ev, "_sender", ["offset"], "event_us", "_prev_us", bucket)
    return out.withColumn("gap_sec", (F.col("event_us") - F.col("_prev_us")) / 1e6).drop("_prev_us", "_sender")


def fraud_alerts(events: DataFrame, partition: int | None = None,
                 split_offsets: int = 1_000_000) -> DataFrame:
    """Batch twin of the fraud consumer: one row per event with any signal."""
    return _alerts(gaps(partition_slice(events, partition), split_offsets=split_offsets))


# --- streaming -------------------------------------------------------------

GAP_FIELDS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("sender_msisdn", T.StringType()),
    T.StructField("amount_ghs", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("is_high_value", T.BooleanType()),
    T.StructField("gap_sec", T.DoubleType()),
])


#: Events that can't have a gap are dealt over so many keys, which hold no state. A key costs a
#: call in the worker for each micro-batch, its rows come in parts: a few for each core are enough.
STATELESS_KEYS = 1 << 6
#: Senders of a reordering query are dealt over so many keys. A checkpoint is for one number.
SENDER_BUCKETS = 1 << 10
#: Rows that the reorder buffer sorts at once, and rows of one of its pieces.
RUN_ROWS, PIECE_ROWS = 1 << 16, 1 << 12
#: Events that a task deals into pieces at once, on their way to the state.
PACK_ROWS = 1 << 17
#: How long ``bounded`` keeps an idle sender's state, by the clock of the cluster.
STATE_TTL_MS = 3_600_000


class LastSeenProcessor(StatefulProcessor):
    """Per sender: the last event time (epoch micros, a plain ``long`` so it
    survives state restore unchanged). Without ``ttl_ms`` every sender's last
    time is kept, like the original consumer does; with it a sender's state goes once
    it has been idle for so long (processing time), which drops no event."""

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("us", T.LongType(), True)])
        self.last = handle.getValueState("last_us", schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = []
        for pdf in rows:
            if pdf["timed"].iloc[0]:
                parts.append(pdf)
            else:
                yield _without_gap(pdf)
        if not parts:
            return
        # A micro-batch's rows of one sender; the source's rate limit bounds them.
        pdf = pd.concat(parts, ignore_index=True).sort_values("offset", kind="stable")
        us = pdf["event_us"].to_numpy(dtype="int64")
        prev = np.empty(len(us), dtype="float64")
        prior = self.last.get() if self.last.exists() else None
        prev[0] = np.nan if prior is None or prior[0] is None else float(prior[0])
        prev[1:] = us[:-1]
        pdf["gap_sec"] = (us - prev) / 1e6
        self.last.update((int(us[-1]),))
        yield pdf[GAP_FIELDS.names]

    def close(self) -> None:
        pass


#: What the reorder buffer holds of an event; ``n``: the piece that it came in.
PENDING = pa.schema([("transaction_id", pa.string()), ("offset", pa.int64()), ("sender_msisdn", pa.string()),
                     ("amount_ghs", pa.float64()), ("status", pa.string()), ("operator", pa.string()),
                     ("region", pa.string()), ("is_high_value", pa.bool_()), ("event_us", pa.int64())])
PIECE = PENDING.append(pa.field("n", pa.int64()))
LAST = pa.schema([("sender_msisdn", pa.string()), ("us", pa.int64())])


def _without_gap(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.assign(gap_sec=np.nan)[GAP_FIELDS.names]


def _packed(table: pa.Table) -> bytes:
    """``table`` as a value of the state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(value))).read_all()


def _in_order(table: pa.Table) -> pa.Table:
    """By offset, equal ones as they came."""
    return table.combine_chunks().take(np.lexsort((table["n"].to_numpy(), table["offset"].to_numpy())))


def _judged(table: pa.Table, last: dict[str, int]) -> pd.DataFrame:
    """Rows in offset order with their gaps; ``last``: each sender's last event time, brought up to date."""
    senders = table["sender_msisdn"].combine_chunks().dictionary_encode()
    code, names = senders.indices.to_numpy(), senders.dictionary.to_pylist()
    by_sender = np.argsort(code, kind="stable")
    code, us = code[by_sender], table["event_us"].to_numpy()[by_sender]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    ends = np.r_[starts[1:], len(code)] - 1
    found = [names[c] for c in code[starts]]
    gap = np.empty(len(us), dtype="float64")
    gap[1:] = (us[1:] - us[:-1]) / 1e6
    gap[starts] = [(u - last[s]) / 1e6 if s in last else np.nan for s, u in zip(found, us[starts].tolist())]
    last.update(zip(found, us[ends].tolist()))
    pdf = table.drop_columns(["event_us", "n"]).to_pandas()
    pdf.loc[by_sender, "gap_sec"] = gap
    return pdf[GAP_FIELDS.names]


#: Events on their way to the state: pieces of one key's rows. ``last``: the largest offset of a piece.
PACKED = "state_key string, timed boolean, last long, rows binary"
PACKED_PIECE = pa.schema([("state_key", pa.string()), ("timed", pa.bool_()), ("last", pa.int64()), ("rows", pa.binary())])


def _pieces(table: pa.Table) -> pa.RecordBatch:
    """``table`` dealt into pieces by key, each sorted by offset."""
    keys = table["state_key"].combine_chunks().dictionary_encode()
    code, names = keys.indices.to_numpy(), keys.dictionary.to_pylist()
    order = np.lexsort((pc.fill_null(table["offset"], 0).to_numpy(), code))
    code, events = code[order], table.select(PENDING.names).cast(PENDING).combine_chunks().take(order)
    timed = table["timed"].to_numpy()[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    rows = []
    for start, end in zip(starts, np.r_[starts[1:], len(code)]):
        for at in range(start, end, PIECE_ROWS):
            piece = events.slice(at, min(PIECE_ROWS, end - at))
            rows.append((names[code[start]], bool(timed[start]), pc.max(piece["offset"]).as_py(), _packed(piece)))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED_PIECE)], schema=PACKED_PIECE)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a task's events, some of them in memory at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= PACK_ROWS:
            yield _pieces(pa.Table.from_batches(held))
            held, size = [], 0
    if size:
        yield _pieces(pa.Table.from_batches(held))


class ReorderProcessor(StatefulProcessor):
    """Per bucket of senders: their last event times, and the events that wait for their turn.

    Offsets are the event time of the query (one offset is one millisecond), so its
    watermark says up to which offset everything has arrived. Events wait in sorted pieces
    of some thousand rows, each one value of a map state by its first offset, and are judged in offset
    order when the watermark has passed them, whatever micro-batches they came in. A timer at
    the smallest offset that waits wakes the bucket up; pieces are then merged, a part of them in
    memory at a time. Calls of the state go by pieces and buckets, never by events or senders.

    The watermark drops what comes too late; of what it lets through, an event that the bucket has
    judged past is dropped here, so that no event is judged after a later one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "senders binary")
        self.pieces = handle.getValueState("pieces", "n long, passed long")
        self.waiting = handle.getMapState("waiting", "first long, n long", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, size, first = [], 0, []
        for pdf in rows:  # a part of the bucket's rows at a time
            for table in self._tables(pdf):
                if not pdf["timed"].iloc[0]:
                    yield _without_gap(table.to_pandas())
                    continue
                held.append(table)
                size += len(table)
                if size >= RUN_ROWS:
                    first += self._store(pa.concat_tables(held))
                    held, size = [], 0
        if held:
            first += self._store(pa.concat_tables(held))
        if first:
            self.handle.registerTimer(min(first))

    def _tables(self, pdf: pd.DataFrame) -> Iterator[pa.Table]:
        yield pa.Table.from_pandas(pdf[PENDING.names], schema=PENDING, preserve_index=False)

    def _store(self, table: pa.Table) -> list[int]:
        """Add rows to those that wait; their first offset, if there are any."""
        n, passed = self.pieces.get() if self.pieces.exists() else (0, None)
        if "n" not in table.column_names:
            table = table.append_column("n", pa.array(np.full(len(table), n, dtype="int64")))
        if passed is not None:
            table = table.filter(pc.greater(table["offset"], passed))
        if not len(table):
            return []
        table = _in_order(table)
        for at in range(0, len(table), PIECE_ROWS):
            piece = table.slice(at, PIECE_ROWS)
            self.waiting.updateValue((piece["offset"][0].as_py(), n), (_packed(piece),))
            n += 1
        self.pieces.update((n, passed))
        return [table["offset"][0].as_py()]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = sorted((int(first), int(n)) for first, n in self.waiting.keys())
        due = [k for k in waiting if k[0] <= passed]
        if not due:  # another timer has released them
            return
        senders = _unpacked(self.last.get()[0]) if self.last.exists() else LAST.empty_table()
        last = dict(zip(*(senders[c].to_pylist() for c in LAST.names)))
        held, at = PIECE.empty_table(), 0
        while at < len(due):
            parts, read = [held], 0
            while at < len(due) and read < max(RUN_ROWS, len(held)):
                parts.append(_unpacked(self.waiting.getValue(due[at])[0]))
                self.waiting.removeKey(due[at])
                read += len(parts[-1])
                at += 1
            held = _in_order(pa.concat_tables(parts))
            # what lies before the next piece is complete
            until = passed if at == len(due) else due[at][0] - 1
            ready = int(np.searchsorted(held["offset"].to_numpy(), until, side="right"))
            if ready:
                yield _judged(held.slice(0, ready), last)
            held = held.slice(ready)
        rest = [k[0] for k in waiting[len(due):]]
        if len(held):
            rest += self._store(held)
        if rest:
            self.handle.registerTimer(min(rest))
        self.pieces.update((self.pieces.get()[0], passed))
        self.last.update((_packed(pa.table([list(last), list(last.values())], schema=LAST)),))

    def close(self) -> None:
        pass


class PackedReorderProcessor(ReorderProcessor):
    """The same for events that come in pieces (:func:`_pack`): the engine hands over input row by row, which
    costs more for an event than judging it."""

    def _tables(self, pdf: pd.DataFrame) -> Iterator[pa.Table]:
        return map(_unpacked, pdf["rows"])


#: ``event_type`` of the mark that ends a replay: its offset lets the last events pass.
END_MARK = "END"


def stream_gaps(events: DataFrame, mode: str = "parity", ttl_ms: int = STATE_TTL_MS, reorder: int | None = None) -> DataFrame:
    """Streaming ``gap_sec`` for every event (keyed state per sender), in arrival order.

    ``parity``: state is kept for every sender seen (a late event gets a
    negative gap). ``bounded``: an idle sender's state expires after ``ttl_ms``;
    a sender's next event then has no gap, like a first one.

    Without ``reorder`` events are ordered by offset within a micro-batch, and micro-batches
    as they come. With it (``parity`` only) they are ordered by offset whatever the micro-batches
    are, as long as no event comes more than ``reorder`` offsets after a later one (such an event
    is dropped with the pieces that the watermark drops, as Spark counts them, or by the processor). An event is judged once one with an offset
    larger by ``reorder`` has come; an :data:`END_MARK` event stands for it at the end of a replay.
    """
    if mode not in ("parity", "bounded"):
        raise ValueError(f"unknown mode {mode!r}")
    if reorder is not None and mode != "parity":
        raise ValueError("reordering needs the parity mode")
    timed = F.col("sender_msisdn").isNotNull() & F.col("event_us").isNotNull()
    if reorder is not None:
        timed = timed & F.col("offset").isNotNull()
    sender = F.col("sender_msisdn")
    if reorder is not None:
        sender = F.pmod(F.xxhash64(sender), F.lit(SENDER_BUCKETS)).cast("string")
    other = F.concat(F.lit("-"), F.pmod(F.xxhash64("offset", "transaction_id"), F.lit(STATELESS_KEYS)).cast("string"))
    ev = (event_time(events).withColumn("timed", timed)
          .withColumn("state_key", F.when(F.col("timed"), F.concat(F.lit("+"), sender)).otherwise(other))
          .withColumn("event_us", F.coalesce("event_us", F.lit(0))))
    cols = [f.name for f in GAP_FIELDS.fields if f.name != "gap_sec"]
    if reorder is not None:
        key = F.when(F.col("event_type").eqNullSafe(END_MARK), END_MARK).otherwise(F.col("state_key"))
        packed = (ev.select(*cols, "event_us", "timed", key.alias("state_key")).mapInArrow(_pack, PACKED)
                  .withColumn("offset_time", F.timestamp_millis("last")).withWatermark("offset_time", f"{int(reorder)} milliseconds")
                  # names the watermark's column, so that the optimizer leaves the filter behind the watermark
                  .where(F.col("offset_time").isNull() | (F.col("state_key") != END_MARK)))
        return packed.groupBy("state_key").transformWithStateInPandas(PackedReorderProcessor(), GAP_FIELDS, "Append", "EventTime")
    keyed = ev.select(*cols, "event_us", "timed", "state_key").groupBy("state_key")
    if mode == "parity":
        return keyed.transformWithStateInPandas(LastSeenProcessor(), GAP_FIELDS, "Append", "None")
    return keyed.transformWithStateInPandas(LastSeenProcessor(ttl_ms), GAP_FIELDS, "Append", "ProcessingTime")


def stream_alerts(events: DataFrame, mode: str = "parity", reorder: int | None = None) -> DataFrame:
    """Streaming fraud alerts (append); see :func:`stream_gaps`."""
    return _alerts(stream_gaps(events, mode, reorder=reorder))
