import math
import random
from collections import Counter
from itertools import product

import numpy as np
import pytest

from paylake.llm import pst
from tests.llm.helpers import corpus, docs_frame


def brute_base(rows, train):
    toks = {i: pst.tokens(t.encode() if t is not None else None) for i, (_, t) in enumerate(rows)}
    c = Counter(w for i, ws in toks.items() if train[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in toks.items()}


def remainder(doc_id, mod):
    import zlib
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


@pytest.mark.parametrize("hot", [pst.HOT, 0.02])
def test_base_score_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(pst, "HOT", hot)  # the second makes most words take the join
    rows = [(i, t) for i, (_, t) in enumerate(corpus(5))] + [(None, "unseen words")]
    df = docs_frame(spark, rows, ["word", "c", "row", "score", "extra", "cold"])
    want = brute_base(rows, [remainder(d, 7) != 2 for d, _ in rows])
    got = pst.score_texts(df).collect()
    assert len(got) == len(rows)
    for r in got:
        i = len(rows) - 1 if r.doc_id is None else r.doc_id
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[i][:3]
        assert r.base_score == pytest.approx(want[i][3], abs=1e-9)
        assert r.held_out == (remainder(r.doc_id, 7) == 2)


class Tree:
    """The suffix tree by direct counting in dictionaries."""

    def __init__(self, texts, depth, least):
        docs = [pst.tokens(t) for t in texts]
        self.words = Counter(w for d in docs for w in d)
        self.total, self.depth, self.lp, self.la = sum(self.words.values()), depth, {}, {}
        grams = {m: Counter(tuple(d[i:i + m]) for d in docs for i in range(len(d) - m + 1)) for m in range(1, depth + 2)}
        for m in grams:
            grams[m] = {g: n for g, n in grams[m].items() if n >= least}
        self.lp.update({g: math.log10(self.base(g[0])) for g in grams[1]})
        for m in range(2, depth + 2):
            following = {}
            for g, n in grams[m].items():
                following.setdefault(g[:-1], {})[g[-1]] = n
            for ctx, nexts in following.items():
                of = grams[m - 1][ctx]
                p = {w: (n - pst.DISCOUNT) / of for w, n in nexts.items()}
                q = {w: 10 ** self.lp[ctx[1:] + (w,)] for w in nexts}
                rest, parent_rest = max(1 - sum(p.values()), 1e-12), max(1 - sum(q.values()), 1e-12)
                kl = sum(p[w] * math.log(p[w] / q[w]) for w in p) + rest * math.log(rest / parent_rest)
                retained = of * kl > 0.5 * (len(p) + 1) * math.log(max(of, 2))
                if retained:
                    self.la[ctx] = math.log10(rest / parent_rest)
                for w in nexts:
                    self.lp[ctx + (w,)] = math.log10(p[w] if retained else q[w])

    def base(self, w):
        return (self.words[w] + 1) / (self.total + len(self.words) + 1)

    def token(self, before, w):
        """The log10 probability of ``w`` after the words ``before`` of its text."""
        now = math.log10(self.base(w))
        for d in range(1, min(self.depth, len(before)) + 1):
            ctx = tuple(before[-d:])
            if ctx in self.la:
                now = self.lp[ctx + (w,)] if ctx + (w,) in self.lp else now + self.la[ctx]
        return now

    def score(self, words):
        return sum(self.token(words[:k], w) for k, w in enumerate(words))


def text_of(rng):
    words = [b"a", b"b", b"c", b"d"]
    out = [rng.choice(words)]
    while len(out) < 40:
        last = out[-2:]
        out.append(b"d" if last == [b"a", b"b"] else rng.choice(words))
    return b" ".join(out)


def test_distributions_sum_to_one_and_contexts_are_used():
    """Of the brute-force tree, and so of what the operator is held against."""
    rng = random.Random(6)
    tree = Tree([text_of(rng) for _ in range(60)], 2, 3)
    assert any(len(c) == 2 for c in tree.la)
    for ctx in product([b"a", b"b", b"c", b"d"], repeat=2):
        assert sum(10 ** tree.token(ctx, w) for w in [*tree.words, b"unseen"]) == pytest.approx(1.0, abs=1e-6)
    assert 10 ** tree.token([b"a", b"b"], b"d") > 0.8


def test_better_than_the_base_on_held_out_texts(spark):
    rng = random.Random(7)
    rows = [(i, text_of(rng).decode()) for i in range(300)]
    got = pst.score_texts(docs_frame(spark, rows)).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > 0.97 * got["sum(base_score)"] > got["sum(base_score)"]


def test_empty_and_nothing_to_learn(spark):
    assert pst.score_texts(docs_frame(spark, [])).count() == 0
    lone = [i for i in range(100) if remainder(i, 7) == 2][:3]
    got = pst.score_texts(docs_frame(spark, [(i, "some text") for i in lone])).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(3, 0, 0, 0.0, 0.0)}


def test_long_text_and_chunks(spark, monkeypatch):
    rows = [(i, "x y z " * 2000) for i in range(5)] + [(10, "x y z " * 30000)]
    got = {r.doc_id: r for r in pst.score_texts(docs_frame(spark, rows)).collect()}
    assert got[10].n_tokens == 90001 and got[10].score > got[10].base_score


def test_chunks_hold_whole_texts():
    import pyarrow as pa
    lists = [[1], [], [2, 3, 4], [5], [6, 7], list(range(20)), [8]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], names=["ids"]).slice(1)
    for chunk in (1, 3, 5, 100):
        got = [ids[a:b].tolist() for _, _, _, ids, starts in pst._numbers([batch], 0, chunk) for a, b in zip(starts, starts[1:])]
        assert got == lists[1:]


@pytest.mark.parametrize("hot, held", [(pst.HOT, 1 << 20), (0.02, 1 << 20), (0.02, 40), (pst.HOT, 0)])
def test_every_frequent_sequence_is_used_however_large_the_corpus(spark, monkeypatch, hot, held):
    monkeypatch.setattr(pst, "HOT", hot)
    monkeypatch.setattr(pst, "HELD", held, raising=False)  # few: the others are joined
    rng = random.Random(11)
    rows = [(i, " ".join([text_of(rng).decode()] + [f"p{i % 9} q{i % 9} r{i % 9}"] + [f"w{rng.randrange(60)}" for _ in range(10)])) for i in range(150)]
    rows += [(150, None), (151, "p1 q1 r1")]
    train = [t for i, t in rows if remainder(i, 7) != 2]
    tree = Tree([(t or "").encode() for t in train], pst.DEPTH, pst.LEAST)
    assert any(len(c) == 2 for c in tree.la)
    got = {r.doc_id: r for r in pst.score_texts(docs_frame(spark, rows)).collect()}
    for i, t in rows:
        words = pst.tokens((t or "").encode())
        assert got[i].score == pytest.approx(tree.score(words), abs=1e-8)


def test_counts_survive_packing():
    rng = random.Random(12)
    for n in (1, 2, 500):
        ctx, word = (np.array([rng.randint(-2**63, 2**63 - 1) if rng.random() < 0.3 else rng.randint(0, 4) for _ in range(n)]) for _ in "ab")
        back = pst._unpacked(pst._packed(ctx, word, np.arange(n)), 3)
        assert all((x == y).all() for x, y in zip(back, (ctx, word, np.arange(n))))
        got = dict(((a, b), c) for a, b, c in zip(*(x.tolist() for x in pst._summed(ctx, word, np.arange(n)))))
        want = Counter()
        for a, b, c in zip(ctx.tolist(), word.tolist(), range(n)):
            want[a, b] += c
        assert got == dict(want) | {k: 0 for k in got if k not in want}


def test_parts_are_summed_whatever_the_chunks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(pst, "SUMMED", 7)
    rng = random.Random(13)
    want, rows = Counter(), []
    for _ in range(40):
        pairs = [(rng.randrange(4), rng.randrange(3)) for _ in range(rng.randint(1, 9))]
        want.update(pairs)
        ctx, word = map(np.array, zip(*pairs))
        rows.append(pst._packed(*pst._summed(ctx, word, np.ones(len(pairs)))))
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[k:k + 5], pa.binary())], names=["packed"]) for k in range(0, 40, 5)]
    out = [r for b in pst._sum_sequences(batches) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert {(a, b): n for a, b, n in out} == {k: n for k, n in want.items() if n >= pst.LEAST} and out
    assert list(pst._sum_sequences([])) == []
