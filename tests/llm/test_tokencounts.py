import os
import random
from collections import Counter

import pytest

from paylake.llm import tokencounts as T
from tests.llm.helpers import corpus, docs_frame

pytestmark = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary file here")


def brute(lengths):
    out = {}
    for x in set(lengths):
        out[x] = (lengths.count(x), sum(n > x for n in lengths), sum(n for n in lengths if n > x), len(lengths), sum(lengths),
                  sum(min(n, x) for n in lengths))
    return out


def encoded(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(os.path.join(os.path.dirname(T.VOCABULARY), "byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_against_another_tokenizer_and_brute_sums(spark):
    rows = corpus(7) + [(900, "<|endoftext|> it's 42  \n\n x"), (901, "a" * 3000), (902, "日本語 😀 عربى")]
    df = docs_frame(spark, rows, ["length", "n_docs", "body", "block"])
    lengths = encoded([t for _, t in rows])
    hist = {r.length: r.n_docs for r in T.length_histogram(df, T.read_ranks()).collect()}
    assert hist == Counter(lengths)
    for block in (T.BLOCK, 16):
        sums = T.suffix_sums(T.length_histogram(df, T.read_ranks()), block)
        got = {r.length: (r.n_docs, r.docs_over, r.tokens_over, r.total_docs, r.total_tokens, r.truncated_tokens) for r in sums.collect()}
        assert got == brute(lengths)
    assert {r.length: r.quantile for r in sums.collect()}[max(lengths)] == 1.0


def test_answers_for_any_limit(spark):
    hist = spark.createDataFrame([(3, 2), (10, 1), (50, 4)], "length long, n_docs long")
    lengths = [3, 3, 10, 50, 50, 50, 50]
    got = {r.limit: (r.docs_over, r.truncated_tokens) for r in T.answer(T.suffix_sums(hist), [1, 3, 7, 10, 49, 50, 99]).collect()}
    assert got == {x: (sum(n > x for n in lengths), sum(min(n, x) for n in lengths)) for x in (1, 3, 7, 10, 49, 50, 99)}


def test_empty(spark):
    assert T.token_counts(docs_frame(spark, [])).count() == 0
    assert [(r.length, r.n_docs, r["quantile"]) for r in T.token_counts(docs_frame(spark, [(1, None), (1, None), (2, "")])).collect()] == [(0, 3, 1.0)]


def test_long_runs_are_cut_exactly():
    """Wherever runs are cut out, the lengths are those of the pattern on the whole text."""
    state, rng = {"ranks": T.read_ranks()}, random.Random(3)
    enc = T.encoder(state)
    for _ in range(3000):
        text = "".join(rng.choice([" ", "  ", "\n", "\t ", "\u00a0", "\u3000", "\x1c", "a", "it's", "42", "!", "é"]) * rng.randint(1, 4)
                       for _ in range(rng.randint(0, 12)))
        assert T.encoded_length(state, text, rng.choice([1, 2, 3, 5])) == len(enc.encode_ordinary(text)), repr(text)


def test_very_long_runs(spark):
    n = 1_000_000
    texts = [" " * n + "x", "x" + "\n" * n, " \n" * (n // 2) + " y", "a" * n, "1" * n, "\u00a0" * 50_000 + "z", "w" + "\t" * 5000 + "\n"]
    got = Counter({r.length: r.n_docs for r in T.length_histogram(docs_frame(spark, list(enumerate(texts))), T.read_ranks()).collect()})
    assert sum(got.values()) == len(texts)
    assert got == Counter(encoded(texts))
