import random

import numpy as np
import xxhash

from paylake.llm import simhash
from tests.llm.helpers import corpus, docs_frame, random_text


def brute_fp(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius=3):
    """fps: id -> fingerprint; returns id -> smallest reachable id."""
    ids, out = sorted(fps), {}
    for i in ids:
        if i in out:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += [y for y in ids if y not in out and (fps[x] ^ fps[y]).bit_count() <= radius]
    return out


def near_corpus():
    rng = random.Random(3)
    words = [f"v{i}" for i in range(300)]
    rows = [(i, random_text(rng, words, 200)) for i in range(40)]
    for i in range(200):  # near copies of a few
        w = rows[i % 8][1].split(" ")
        w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((1000 + i, " ".join(w)))
    return rows + [(None if d is None else d + 5000, t) for d, t in corpus(4)]


def test_against_brute_force(spark):
    rows = near_corpus()
    got = simhash.near_duplicates(docs_frame(spark, rows, ["fp", "id", "rep", "component", "body"])).collect()
    assert len(got) == len(rows)
    fps = {float("inf") if d is None else d: brute_fp(t) for d, t in rows}
    want = brute_components(fps)
    for r in got:
        d = float("inf") if r.doc_id is None else r.doc_id
        assert r.fp % (1 << 64) == fps[d]
        assert (float("inf") if r.component_id is None else r.component_id) == want[d]
    assert len(set(want.values())) < len(want)


def test_links_of_dense_and_sparse_shards(spark):
    rng = random.Random(8)
    center = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(500)}
    for _ in range(700):  # one dense group
        x = center
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    chain = rng.getrandbits(64)
    for k in range(0, 60, 3):  # a chain of links of distance 3
        fps.add(chain)
        chain ^= 7 << k
    by = dict(enumerate(sorted(fps)))
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in by.items()], "fp long, rep long")
    want = brute_components(by)
    for tile in (4096, 50):
        found = {r.node: r.component for r in simhash.components(simhash.link_edges(reps, tile=tile)).collect()}
        assert {i: found.get(i, i) for i in by} == want


def test_more_blocks_lose_no_link(spark, monkeypatch):
    rng = random.Random(9)
    by = {}
    for i in range(100):
        by[2 * i] = rng.getrandbits(64)
        by[2 * i + 1] = by[2 * i]
        for b in rng.sample(range(64), rng.randint(1, 3)):
            by[2 * i + 1] ^= 1 << b
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in by.items()], "fp long, rep long")
    for blocks in (5, 6):
        monkeypatch.setattr(simhash, "_blocks", lambda n, r, b=blocks: (b, b - r))
        found = {r.node: r.component for r in simhash.components(simhash.link_edges(reps)).collect()}
        assert all(found[2 * i + 1] == 2 * i for i in range(100))
    assert simhash._blocks.__call__(1, 3) == (6, 3)


def test_forest_finds_every_link_once():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 12, 400, dtype=np.uint64))
    forest = simhash.Forest(fps, np.zeros(len(fps), np.int64))
    got = sorted((int(a), int(b)) for x, y in forest.links(2) for a, b in zip(x, y))
    assert got == [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 2]


def test_keep_one(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (7, "quite other words stand in here"), (None, None), (9, ""), (9, "")]
    out = simhash.keep_one(docs_frame(spark, rows))
    assert out.columns == docs_frame(spark, rows).columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 7, 9]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs_frame(spark, [])).count() == 0


def test_missing_and_repeated_ids_lose_no_document(spark):
    rng = random.Random(2)
    words = [f"v{i}" for i in range(300)]
    texts = [random_text(rng, words, 100) for _ in range(6)]
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0]), (7, texts[4]), (7, texts[5]), (3, texts[1])]
    df = docs_frame(spark, rows, ["row", "id", "body", "copy", "l_id"])
    out = simhash.keep_one(df)
    assert out.columns == df.columns and {r.l_id for r in out.collect()} == {"x"}
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(None, texts[0]), (None, texts[2]), (None, texts[3]), (7, texts[4]), (7, texts[5]), (3, texts[1])], key=str)
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {(None, None), (None, 3), (7, 7), (3, 3)}
