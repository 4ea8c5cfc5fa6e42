from collections import defaultdict

from paylake.llm import packing
from tests.llm.helpers import corpus, docs_frame


def brute_pack(pieces, capacity):
    """Best fit by trying every open bin."""
    bins, placed = [], [None] * len(pieces)
    for k in sorted(range(len(pieces)), key=lambda k: (-pieces[k][0], k)):
        size, src, clu = pieces[k]
        fits = [(b["left"], n) for n, b in enumerate(bins) if b["left"] >= size and (src < 0 or src not in b["src"]) and (clu < 0 or clu not in b["clu"])]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"left": capacity, "src": set(), "clu": set()})
        b = bins[n]
        placed[k] = (n, capacity - b["left"])
        b["left"] -= size
        b["src"].add(src)
        b["clu"].add(clu)
    return placed


def test_pack_against_brute_force():
    import random
    rng = random.Random(1)
    for _ in range(30):
        pieces = [(rng.randint(1, 40), rng.choice([0, 0, 0, 1, 2, 3, -1]), rng.choice([-1, -1, 0, 1])) for _ in range(rng.randint(0, 120))]
        assert packing.pack(pieces, 50) == brute_pack(pieces, 50)


def test_many_small_pieces_of_one_source():
    import time
    began = time.time()
    placed = packing.pack([(1, 0, -1)] * 100_000, packing.CAPACITY)
    assert [b for b, _ in placed] == list(range(100_000)) and time.time() - began < 60
    two = packing.pack([(1, k % 2, -1) for k in range(20_000)], packing.CAPACITY)
    assert max(b for b, _ in two) == 9_999


def check(rows, got, capacity, by_source=True):
    sizes = sorted(len((t or "").encode().split()) + 1 for _, t, *_ in rows)
    assert sum(sizes) == sum(r.n_tokens for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
    for b in bins.values():
        assert sum(r.n_tokens for r in b) <= capacity
        ends = sorted((r.bin_offset, r.bin_offset + r.n_tokens) for r in b)
        assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))
        if by_source:
            assert len({r.source or "" for r in b}) == len(b)
    return bins


def test_whole_and_without_conflicts(spark):
    rows = [(d, t, "en", f"s{(d or 0) % 7}") for d, t in corpus(6)]
    rows += [(500 + i, "the very same text", "en", f"c{i}") for i in range(60)] + [(700, "w " * 5000, "en", None), (700, "w " * 5000, "en", None)]
    df = docs_frame(spark, rows, ["shard", "bin", "cluster", "piece", "id", "start", "offset"])
    got = packing.pack_documents(df, capacity=200, shard_bins=8).collect()
    bins = check(rows, got, 200)
    same = [b for b, rs in bins.items() for r in rs if r.doc_id is not None and 500 <= r.doc_id < 600]
    assert len(same) == len(set(same)) == 60
    pieces = sorted((r.piece, r.start_word, r.n_tokens) for r in got if r.doc_id == 700)
    assert pieces[:2] == [(0, 0, 200)] * 2 and pieces[-1] == (25, 5000, 1)
    assert len({b // (1 << 24) for b in bins}) > 1


def test_without_source_conflicts_bins_are_full(spark):
    rows = [(i, "w " * (9 + i % 31), "en", "hot") for i in range(400)]
    got = packing.pack_documents(docs_frame(spark, rows), capacity=100, by_source=False).collect()
    bins = check(rows, got, 100, False)
    total = sum(r.n_tokens for r in got)
    assert len(bins) <= 1.25 * -(-total // 100) or len({r.n_tokens for r in got}) < 3


def test_repeatable_and_empty(spark):
    rows = [(d, t, "en", f"s{(d or 0) % 7}") for d, t in corpus(6) if d is not None]
    df = docs_frame(spark, rows)
    assert sorted(packing.pack_documents(df).collect()) == sorted(packing.pack_documents(df).collect())
    assert packing.pack_documents(df.limit(0)).count() == 0
