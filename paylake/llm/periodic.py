"""Periodic run detection in texts.

Method: suffix trees with constant-time longest common extensions. Ukkonen trees of a
word sequence and of its reversal are toured (Euler tour); the depth of the lowest
common ancestor of two leaves, a range minimum over the tour, is the length of the
longest common extension to the right (and, in the reversed tree, to the left). Every
run's Lyndon root is the longest Lyndon word of some position under the order of
the words or under its inverse, so the two Lyndon words of each position are the
candidates; each is extended in both directions.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of consecutive
words with smallest period ``q`` and at least ``max(min_length, min_exponent * q)`` words
that no neighbouring word extends.

Trees are built only where a run can be: in a run of at least four periods every three
successive words occur three times or more in the text, so a text is first cut to the
stretches whose word triples all do (exact: a hashed triple may only add words to a
stretch, and a run lies in one stretch with all words that could extend it).

Scale: one pass over the texts, no shuffle. A stretch of m words takes O(m log m) time
and about 1 KB a word in its task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, texts_of

MIN_LENGTH = 6
MIN_EXPONENT = 4

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def ukkonen(s: list[int], width: int):
    """The suffix tree of ``s``, whose last symbol occurs nowhere else; symbols are below
    ``width``. Returns for each node where its edge's label starts and ends in ``s``, and
    ``children``: node * width + first symbol -> child."""
    n = len(s)
    start, end, link, children = [0], [0], [0], {}
    node, edge, length, pending = 0, 0, 0, 0
    for i, c in enumerate(s):
        pending += 1
        unlinked = 0
        while pending:
            if not length:
                edge = i
            key = node * width + s[edge]
            child = children.get(key)
            if child is None:
                children[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                size = min(end[child], i + 1) - start[child]
                if length >= size:
                    edge, length, node = edge + size, length - size, child
                    continue
                if s[start[child] + length] == c:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                middle = len(start)
                start += [start[child], i]
                end += [start[child] + length, n]
                link += [0, 0]
                children[key] = middle
                children[middle * width + c] = middle + 1
                start[child] += length
                children[middle * width + s[start[child]]] = child
                if unlinked:
                    link[unlinked] = middle
                unlinked = middle
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return start, end, children


def tour(s: list[int], start, end, children, width: int, inverse: bool = False):
    """The leaves of an Euler tour as suffix positions, and for each leaf the least depth
    that the tour passed since the leaf before. Children are visited by their first symbol
    (``inverse``: the end symbol 0, then from the largest down)."""
    n = len(s)
    below: list[list[int]] = [[] for _ in start]
    # What is pushed last is visited first.
    for key in sorted(children, reverse=not inverse):
        below[key // width].append(children[key])
    if inverse:
        for kids in below:
            if kids and s[start[kids[0]]] == 0:
                kids.append(kids.pop(0))
    leaves, lows, low = [], [], 0
    stack = [(child, 0) for child in below[0]]
    while stack:
        child, depth = stack.pop()
        low = min(low, depth)
        depth += end[child] - start[child]
        kids = below[child]
        if kids:
            stack += [(x, depth) for x in kids]
        else:
            leaves.append(n - depth)
            lows.append(low)
            low = depth
    return leaves, lows


class Extensions:
    """Longest common extensions to the right of pairs of positions, in constant time."""

    def __init__(self, s: list[int], width: int):
        import numpy as np

        self.tree = ukkonen(s, width)
        leaves, lows = tour(s, *self.tree, width)
        self.rank = np.empty(len(s), np.int64)
        self.rank[leaves] = np.arange(len(s))
        levels = [np.array(lows, np.int32)]
        while 2 << (len(levels) - 1) <= len(s):
            last, half = levels[-1], 1 << (len(levels) - 1)
            levels.append(np.concatenate([np.minimum(last[:-half], last[half:]), last[-half:]]))
        self.minima = np.stack(levels)

    def of(self, i, j):
        """Arrays of different positions -> lengths."""
        import numpy as np

        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        return np.minimum(self.minima[k, lo], self.minima[k, hi - (1 << k)]).astype(np.int64)


def _lyndon_ends(rank: list[int]) -> list[int]:
    """Where the longest Lyndon word from each position ends: at the next smaller suffix."""
    ends, stack = [0] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            ends[stack.pop()] = i
        stack.append(i)
    return ends


def runs_of(ids, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers, in this order."""
    import numpy as np

    n = len(ids)
    distinct, s = np.unique(ids, return_inverse=True)
    s = (s + 1).tolist() + [0]
    width = len(distinct) + 1
    ahead, back = Extensions(s, width), Extensions(s[-2::-1] + [0], width)
    inverse = np.empty(n + 1, np.int64)
    inverse[tour(s, *ahead.tree, width, inverse=True)[0]] = np.arange(n + 1)
    i = np.tile(np.arange(n), 2)
    j = np.array(_lyndon_ends(ahead.rank.tolist())[:n] + _lyndon_ends(inverse.tolist())[:n], np.int64)
    i, j = i[j < n], j[j < n]
    period = j - i
    left = np.where(i > 0, back.of(n - i, n - j), 0) if n else i
    length = left + period + ahead.of(i, j)
    good = length >= np.maximum(min_length, min_exponent * period)
    return sorted(set(zip((i - left)[good].tolist(), length[good].tolist(), period[good].tolist())))


def stretches(ids, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Parts (from, to) of a sequence outside of which no run can have a word."""
    import numpy as np

    n, least = len(ids), max(min_length, min_exponent)
    times = min(min_exponent - 1, least - 2)
    if n < least:
        return []
    if times < 2 or n < 3:
        return [(0, n)]
    ids = ids.astype(np.uint64)
    triples = (ids[:-2] * np.uint64(0x9E3779B97F4A7C15) + ids[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + ids[2:]
    _, at, count = np.unique(triples, return_inverse=True, return_counts=True)
    if count.max() < times:
        return []
    often = np.concatenate([[0], (count >= times)[at], [0]]).astype(np.int8)
    step = np.diff(often)
    return [(a, b + 2) for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()) if b + 2 - a >= least]


def word_runs(words: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, in this order."""
    import numpy as np

    if len(words) < max(min_length, min_exponent):
        return []
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    return [(a + start, length, q) for a, b in stretches(ids, min_length, min_exponent)
            for start, length, q in runs_of(ids[a:b], min_length, min_exponent)]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that follow the first period of a run."""
    out, at = [], 0
    for a, b in sorted((start + q, start + length) for start, length, q in runs):
        if b > at:
            out += words[at:max(a, at)]
            at = b
    return out + words[at:]


def _scan(min_length: int, min_exponent: int, alter):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            total, found, texts = [], [], []
            for d, t in zip(b.column(0).to_pylist(), texts_of(b, 1)):
                words = (t or b"").split()
                if alter:
                    words = alter(d, words)
                runs = word_runs(words, min_length, min_exponent)
                total.append(len(words))
                found.append([{"start": x, "length": y, "period": z} for x, y, z in runs])
                texts.append(b" ".join(collapse(words, runs) if runs else words))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(found, kind),
                                              pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT, alter: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Rows ``(<id_col>, n_words, runs, collapsed)``, one for each input row.

    ``runs`` holds (start, length, period) by start, then period; ``collapsed`` is the
    words joined by one space without those that any run contains after its first period.
    ``alter`` (id, words) may replace a text's words first.

    - null, empty or blank text: no words, no runs, empty ``collapsed``;
    - runs that overlap or nest are all returned; two of the same stretch with different
      smallest periods don't exist;
    - repeated rows, repeated and null ids: each row is answered by itself;
    - very long texts: whole; only the stretches with repeated triples get trees;
    - other columns are ignored, whatever their names; an empty table gives none.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_scan(min_length, min_exponent, alter), f"id {kind}, n_words long, runs {RUNS}, collapsed string")
    return out.withColumnRenamed("id", id_col)
