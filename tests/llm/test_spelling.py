import random
import re
import zlib
from collections import Counter

import pytest

from paylake.llm import spelling as S
from paylake.llm.queries import misspelt
from tests.llm.helpers import corpus, docs_frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=2):
    """word -> (form, root, n, n_near, form_n)"""
    best, found = {}, {}
    for w in counts:
        others = [x for x in counts if near(w, x)]
        found[w] = len(others)
        form = min(others, key=lambda x: (-counts[x], x), default=None)
        best[w] = form if form is not None and counts[form] >= ratio * counts[w] else None

    def root(w):
        while best[w] is not None:
            w = best[w]
        return w

    return {w: (best[w], root(w), counts[w], found[w], counts.get(best[w])) for w in counts}


def grouped(spark, counts, **options):
    rows = S.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long"), **options).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("seed,max_block,least", [(0, 4096, 5), (1, 3, 1), (2, 25, 4)])
def test_groups_against_brute_force(spark, seed, max_block, least):
    """Small blocks are dealt again and again, down to one place; ties of counts are common."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé"[:rng.randint(1, 3)]) for _ in range(rng.randint(least, 9))) for _ in range(500)}
    counts = {w: rng.randint(1, 30) for w in words}
    assert grouped(spark, counts, max_block=max_block) == brute(counts)


def test_chains_ties_and_the_empty_table(spark):
    counts = {"house": 100, "hause": 50, "hausee": 25, "haausee": 12, "xhaausee": 6, "mouse": 200, "zebra": 3, "zebrx": 3,
              "tiger": 10, "tigar": 20, "tigxr": 20, "aaaaa": 4, "aaaaaa": 8, "aaaaaaa": 2}
    got = grouped(spark, counts)
    assert got == brute(counts)
    assert got["xhaausee"][1] == "mouse" and got["zebra"][:2] == (None, "zebra")
    assert got["tiger"][0] == "tigar"  # of equal counts the smaller word
    assert S.spelling_groups(spark.createDataFrame([], "word string, n long")).count() == 0
    with pytest.raises(ValueError):
        S.spelling_groups(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_a_block_is_searched_like_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        size = rng.randint(1, 6)
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([size, size + 1]))) for _ in range(12)})
        counts = [rng.randint(1, 9) for _ in words]
        # two ranges of places together see every pair once
        cut = size // 2
        total = Counter()
        for lo, hi in ((0, cut), (cut, size + 1)):
            blocks = {}
            for w, n in zip(words, counts):
                blocks.setdefault((w[:lo], w[len(w) - max(0, size - hi):]), []).append((w, n))
            for members in blocks.values():
                ws, ns = [w for w, _ in members], [n for _, n in members]
                for w, x in zip(ws, S.block_matches(ws, ns, size, lo, hi)):
                    total[w] += x[0] if x else 0
        for w in words:
            # pairs of two longer words belong to the next size
            expected = sum(near(w, x) and min(len(w), len(x)) == size for x in words)
            assert total[w] == expected, (w, words)


def counted(rows, alter=None):
    out = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            if alter:
                w = alter(d, w)
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def test_lexicon_with_odd_texts(spark):
    rows = corpus(4) + [(700, "Été été ÉTÉ naïve-NAÏVE naïves " * 3), (701, "wordy " * 5000), (None, "wordy wordy"), (702, "Straße×größer " * 3)]
    df = docs_frame(spark, rows, ["id", "word", "n"])
    assert {r.word: r.n for r in S.lexicon(df).collect()} == counted(rows)
    assert {r.word: r.n for r in S.lexicon(df, alter=misspelt).collect()} == counted(rows, misspelt)
    assert S.lexicon(df.limit(0)).count() == 0


def test_the_contracts_change_of_a_word():
    for d in range(400):
        h = zlib.crc32(f"{d}:été".encode())
        assert misspelt(d, "été") == ("été" if h % 97 else "été"[:h % 3] + "été"[h % 3 + 1:])
    assert any(misspelt(d, "wordy") != "wordy" for d in range(400))
