"""Stream results that don't depend on how events fall into micro-batches, and exact throughput."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from paylake.replay import end_mark, range_size, replay_in_order
from paylake.schemas import EVENT
from paylake.sources.fixtures import live_events
from paylake.streaming import fraud as FR
from paylake.streaming import jobs as J
from test_streaming import ODD, _event


def _gap(r):
    return (r.transaction_id, r.offset, r.sender_msisdn, r.gap_sec)


def _replayed(spark, events, parts, start, **source):
    """Ranges written in many files whose offsets interleave, each taken in several micro-batches."""
    src, out, ckpt = (J.scratch(spark, f"order-{x}") for x in ("in", "out", "ckpt"))
    reach = range_size(events, parts)
    dealt = events.repartition(6, "sender_msisdn")
    replay_in_order(dealt, src, parts, lambda: J.drain(start(J.read_events(spark, src, **source), out, ckpt, reorder=reach)), reach)
    return spark.read.parquet(out)


def test_gaps_equal_the_batch_twin_for_any_split(spark):
    events = live_events(spark, SF_SMALL).where("offset <= 400").cache()
    expected = sorted(map(_gap, FR.gaps(events).collect()), key=str)
    assert len(expected) == 400
    for source in ({"bytes_per_batch": 4000}, {"files_per_batch": 4}):
        assert sorted(map(_gap, _replayed(spark, events, 2, J.start_gaps, **source).collect()), key=str) == expected
    events.unpersist()


def test_alerts_equal_the_batch_twin_in_any_order(spark):
    rows = [e for b in ODD for e in b] + [_event(k, f"2024-01-01T00:01:{k:02d}", sender=f"S{k % 3}", amount=700.0 * (k % 2)) for k in range(9, 40)]
    expected = sorted((r.transaction_id, tuple(r.alerts)) for r in FR.fraud_alerts(spark.createDataFrame(rows, EVENT)).collect())
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        src, out, ckpt = (J.scratch(spark, f"any-{x}") for x in ("in", "out", "ckpt"))
        for k in range(0, len(rows), 13):
            spark.createDataFrame(rows[k:k + 13], EVENT).coalesce(1).write.mode("append").parquet(src)
        end_mark(spark.createDataFrame(rows, EVENT), 100).coalesce(1).write.mode("append").parquet(src)
        J.drain(J.start_alerts(J.read_events(spark, src, files_per_batch=1), out, ckpt, reorder=99))
        assert sorted((r.transaction_id, tuple(r.alerts)) for r in spark.read.parquet(out).collect()) == expected


def test_events_wait_for_those_before_them(spark):
    src, out, ckpt = (J.scratch(spark, f"wait-{x}") for x in ("in", "out", "ckpt"))
    seen = lambda: sorted((r.offset, r.gap_sec) for r in spark.read.schema(FR.GAP_FIELDS).parquet(out).collect())

    def feed(*events):
        spark.createDataFrame(list(events), EVENT).coalesce(1).write.mode("append").parquet(src)
        J.drain(J.start_gaps(J.read_events(spark, src), out, ckpt, reorder=10))

    feed(_event(3, "2024-01-01T00:00:09"), _event(5, "2024-01-01T00:00:30"))
    assert seen() == []
    feed(_event(1, "2024-01-01T00:00:00"), _event(13, "2024-01-01T00:01:00"))  # all up to 3 is in
    assert seen() == [(1, None), (3, 9.0)]
    feed(_event(4, "2024-01-01T00:00:10"), _event(40, "2024-01-01T00:02:00"))
    assert seen() == [(1, None), (3, 9.0), (4, 1.0), (5, 20.0), (13, 30.0)]


def test_reordering_is_for_parity(spark):
    with pytest.raises(ValueError, match="parity"):
        FR.stream_gaps(None, "bounded", reorder=5)


def test_throughput_over_many_batches(spark):
    src, out, ckpt = (J.scratch(spark, f"rate-{x}") for x in ("in", "out", "ckpt"))
    one = spark.createDataFrame([_event(k, "2024-01-01T00:00:00") for k in range(300)], EVENT)
    one.repartitionByRange(150, "offset").write.parquet(src)
    files = spark.read.parquet(src).select(F.input_file_name()).distinct().count()
    assert files == 150
    counted = J.Throughput()
    spark.streams.addListener(counted)
    try:
        for part in ("first", "second"):
            q = J.start_log(J.observed(J.read_events(spark, src, files_per_batch=1)), out, ckpt)
            J.drain(q)
            s = counted.summary(q)
            if part == "first":
                assert len(q.recentProgress) <= 100
                assert s["batches"] >= 150 and s["input_rows"] == 300 and s["rows_per_sec"] >= s["mean_rows_per_sec"] > 0
                spark.createDataFrame([_event(300, "2024-01-01T00:00:00")], EVENT).coalesce(1).write.mode("append").parquet(src)
        assert s["input_rows"] == 301
    finally:
        spark.streams.removeListener(counted)


class _Handle:
    """A state in memory that counts its calls."""

    def __init__(self):
        self.calls, self.timers = 0, []

    def getValueState(self, *_):
        return _State(self)

    getMapState = getListState = getValueState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


class _State:
    def __init__(self, handle):
        self.handle, self.held = handle, {}

    def _called(self, result=None):
        self.handle.calls += 1
        return result

    def exists(self):
        return self._called(bool(self.held))

    def get(self):
        return self._called(self.held[None])

    def update(self, value):
        self._called(self.held.update({None: value}))

    def getValue(self, key):
        return self._called(self.held[key])

    def updateValue(self, key, value):
        self._called(self.held.update({key: value}))

    def removeKey(self, key):
        self._called(self.held.pop(key))

    def keys(self):
        return self._called(list(self.held))

    def appendList(self, values):
        self.handle.calls += len(values)
        self.held.setdefault(None, []).extend(values)


@pytest.mark.parametrize("run_rows, piece_rows", [(40, 7), (FR.RUN_ROWS, FR.PIECE_ROWS)])
def test_reordering_calls_the_state_by_pieces(monkeypatch, run_rows, piece_rows):
    """Many senders of a bucket in any order, released in steps that cut pieces."""
    import numpy as np
    import pandas as pd
    monkeypatch.setattr(FR, "RUN_ROWS", run_rows)
    monkeypatch.setattr(FR, "PIECE_ROWS", piece_rows)
    rnd = random.Random(3)
    events = [(f"T{o}", o, f"S{rnd.randrange(300)}", 1.0, "SUCCESS", "MTN", None, rnd.choice((True, None)), rnd.randrange(10 ** 9)) for o in range(1, 6001)]
    last, expected = {}, []
    for e in events:
        expected.append((e[1], e[2], None if e[2] not in last else (e[-1] - last[e[2]]) / 1e6))
        last[e[2]] = e[-1]
    handle, got = _Handle(), []
    p = FR.ReorderProcessor()
    p.init(handle)
    for k in range(3):  # each third reaches 500 offsets into the next
        rows = [e for e in events if (e[1] + (e[1] * 7919) % 500 - 1) // 2500 == k]
        rnd.shuffle(rows)
        parts = [pd.DataFrame(rows[i:i + 100], columns=FR.PENDING.names).assign(timed=True) for i in range(0, len(rows), 100)]
        assert list(p.handleInputRows(("+1",), iter(parts), None)) == []
        passed = type("T", (), {"getCurrentWatermarkInMs": staticmethod(lambda k=k: 2500 * (k + 1) - 500 if k < 2 else 10_000)})
        while handle.timers and min(handle.timers) <= passed.getCurrentWatermarkInMs():
            handle.timers.remove(min(handle.timers))
            for pdf in p.handleExpiredTimer(("+1",), passed, None):
                got += [(r.offset, r.sender_msisdn, None if np.isnan(r.gap_sec) else r.gap_sec) for r in pdf.itertuples()]
        assert len(got) == min(6000, passed.getCurrentWatermarkInMs())
    assert got == expected
    assert handle.calls < (6000 if piece_rows == 7 else 100)


def test_events_without_a_gap_share_few_keys():
    assert FR.STATELESS_KEYS <= 1024 and FR.SENDER_BUCKETS <= 1 << 14


def _packed_frames(rows, keys, batch=700):
    import pandas as pd
    import pyarrow as pa
    df = pd.DataFrame(rows, columns=FR.PENDING.names)
    table = pa.Table.from_pandas(df, schema=FR.PENDING, preserve_index=False)
    table = table.append_column("timed", pa.array([k.startswith("+") for k in keys])).append_column("state_key", pa.array(keys))
    return list(FR._pack(iter(table.to_batches(batch))))


def test_events_reach_the_state_in_pieces(monkeypatch):
    """The engine hands its input over row by row: a row is a piece of a key's events."""
    monkeypatch.setattr(FR, "PACK_ROWS", 3000)
    rnd = random.Random(5)
    rows = [(f"T{o}", o if o % 50 else None, f"S{o % 7}", 1.0, "SUCCESS", None, "ASIA", o % 3 == 0, o * 10) for o in range(1, 8001)]
    rnd.shuffle(rows)
    keys = [f"+{r[1] % 7}" if r[1] is not None else "-3" for r in rows]
    pieces = [p for b in _packed_frames(rows, keys) for p in b.to_pylist()]
    assert len(pieces) <= 40
    back = []
    for p in pieces:
        part = FR._unpacked(p["rows"]).to_pylist()
        offsets = [e["offset"] for e in part]
        assert p["timed"] == (p["state_key"] != "-3") and len(part) <= FR.PIECE_ROWS
        assert p["last"] == (max(offsets) if p["timed"] else None)
        assert not p["timed"] or (offsets == sorted(offsets) and {f"+{o % 7}" for o in offsets} == {p["state_key"]})
        back += [tuple(e.values()) for e in part]
    assert sorted(back) == sorted(rows)


def test_no_event_is_judged_after_a_later_one():
    """Of a piece that the watermark lets through, what the bucket has judged past is dropped."""
    p, handle = FR.PackedReorderProcessor(), _Handle()
    p.init(handle)

    def step(offsets, passed):
        rows = [(f"T{o}", o, "S", 1.0, "SUCCESS", None, None, None, o * 1_000_000) for o in offsets]
        pdfs = (b.to_pandas() for b in _packed_frames(rows, ["+1"] * len(rows)))
        assert list(p.handleInputRows(("+1",), pdfs, None)) == []
        at = type("T", (), {"getCurrentWatermarkInMs": staticmethod(lambda: passed)})
        return [(r.offset, r.gap_sec) for pdf in p.handleExpiredTimer(("+1",), at, None) for r in pdf.itertuples()]

    assert [o for o, _ in step([4, 2, 9], 5)] == [2, 4]
    assert step([3, 5, 7, 12], 10) == [(7, 3.0), (9, 2.0)]
    assert step([1], 11) == []
    assert step([13], 20) == [(12, 3.0), (13, 1.0)]


def test_state_partitions_follow_the_cores(spark):
    """A partition costs its files in the checkpoint for every micro-batch: 200 of them are for few senders no gain."""
    src = J.scratch(spark, "few-in")
    spark.createDataFrame([_event(k, f"2024-01-01T00:00:{k:02d}") for k in range(1, 9)], EVENT).write.parquet(src)
    most = max(J.STATE_PARTITIONS, spark.sparkContext.defaultParallelism)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(most + 30))
    try:
        for start, options in ((J.start_gaps, {"reorder": 9}), (J.start_metrics, {})):
            q = start(J.read_events(spark, src), J.scratch(spark, "few-out"), J.scratch(spark, "few-ckpt"), **options)
            J.drain(q)
            assert q.lastProgress.stateOperators[0].numShufflePartitions == most
            assert spark.conf.get("spark.sql.shuffle.partitions") == str(most + 30)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_consumers_share_one_replay(spark, monkeypatch):
    from paylake import registry
    fed = []
    replay = registry.replay_in_order
    monkeypatch.setattr(registry, "replay_in_order", lambda events, path, *args: fed.append(path) or replay(events, path, *args))
    n = live_events(spark, SF_SMALL).count()
    assert sorted(map(tuple, registry.stream_throughput(spark, SF_SMALL).collect())) == [("alerts", n), ("log", n), ("metrics", n)]
    assert len(fed) == 1
