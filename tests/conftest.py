import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from paylake.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app="paylake-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paylake-test-ckpt-"))
    yield s
    s.stop()


def raw_frame(spark, rows):
    """A raw feed from tuples ``(ingest_seq, transaction_id, timestamp, sender,
    amount, status, region, fee)``; other columns get fixed values."""
    from paylake.schemas import RAW_COLUMNS
    full = []
    for seq, tid, ts, sender, amount, status, region, fee in rows:
        d = {"transaction_id": tid, "timestamp": ts, "sender_msisdn": sender, "receiver_msisdn": "0550000001",
             "amount": amount, "currency": "GHS", "transaction_type": "P2P", "operator": "MTN",
             "status": status, "region": region, "fee": fee}
        full.append((seq,) + tuple(d[c] for c in RAW_COLUMNS))
    schema = "ingest_seq long, " + ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.createDataFrame(full, schema)
