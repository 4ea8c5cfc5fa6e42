import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from paylake.llm import periodic as P
from paylake.llm.queries import made_periodic, op12_periodic
from tests.llm.helpers import corpus, docs_frame


def brute(w, least=6, exponent=4):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i + q - a
            run = w[a:a + size]
            if size >= max(least, exponent * q) and not any(run[r:] == run[:-r] for r in range(1, q)):
                out.append((a, size, q))
    return sorted(out)


def random_words(rng):
    w = [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(0, 60))]
    if w and rng.random() < 0.5:
        a, p = rng.randrange(len(w)), rng.randint(1, 8)
        w = [w[min(len(w) - 1, a + (k - a) % p)] if k >= a else w[k] for k in range(len(w))]
    return [b"%d" % x for x in w]


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(2000):
        w = random_words(rng)
        for least, exponent in ((6, 4), (1, 2), (3, 3), (8, 5)):
            assert P.word_runs(w, least, exponent) == brute(w, least, exponent), (w, least, exponent)


def test_extensions_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randint(1, 3) for _ in range(rng.randint(1, 40))] + [0]
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]
        got = P.Extensions(s, 4).of(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
        for (i, j), k in zip(pairs, got):
            common = 0
            while max(i, j) + common < len(s) and s[i + common] == s[j + common]:
                common += 1
            assert k == common


def test_texts_are_cut_only_where_no_run_is():
    rng = random.Random(3)
    vocabulary = [b"w%d" % k for k in range(30)]
    for _ in range(30):
        w = [rng.choice(vocabulary) for _ in range(300)]
        a, p = rng.randrange(250), rng.randint(1, 9)
        w[a:a + 50] = (w[a:a + p] * 50)[:50]
        assert P.word_runs(w) == brute(w) != []


def collapsed(w, runs):
    gone = {k for start, size, q in runs for k in range(start + q, start + size)}
    return b" ".join(x for k, x in enumerate(w) if k not in gone)


def test_collapse_with_overlapping_and_nested_runs():
    rng = random.Random(4)
    for _ in range(500):
        w = random_words(rng)
        runs = brute(w, 2, 2)
        assert b" ".join(P.collapse(w, runs)) == collapsed(w, runs)


def test_operator_on_odd_texts(spark):
    rows = corpus(6) + [(800, "na " * 500), (801, ("a b " * 40 + "c ") * 8), (802, "x y " * 12), (803, "go " * 5), (804, "go " * 6),
                        (805, " ".join(f"w{k % 700}" for k in range(20_000)))]
    df = docs_frame(spark, rows, ["id", "runs", "n_words", "collapsed"])
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in P.periodic_runs(df).collect()), key=str)
    expected = []
    for d, t in rows:
        w = (t or "").encode().split()
        runs = brute(w) if len(w) < 4000 else P.word_runs(w)
        expected.append((d, len(w), runs, collapsed(w, runs).decode()))
    assert got == sorted(expected, key=str)
    by_id = {r[0]: r[2] for r in got}
    assert by_id[803] == [] and by_id[804] == [(0, 6, 1)] and by_id[805] == [(0, 20_000, 700)]
    assert len(by_id[801]) == 9  # the nested runs of a and b, and the run of all of it
    assert P.periodic_runs(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(path + "/documents.parquet").collect()}
    found = 0
    for r in op12_periodic(spark, path).collect():
        w = (docs[r.doc_id] or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute(w) if n < 3000 else P.word_runs(w)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        found += bool(runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{x},{y},{z}\n" for x, y, z in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs)).hexdigest()
    assert found > 10
    assert made_periodic(None, [b"a", b"b"]) == [b"a", b"b"]
