"""Spelling variant grouping.

Method: a bit-sliced position index. For each (position, letter) a bitset over the words
of a block says which words have that letter there. A query word is run through the
index once; the recurrences update, for all words of the block at a time, the set without
an error so far and the sets with one: a replaced letter (same position) and an inserted
letter (positions shifted by one). A deleted letter is the insertion seen from the other word.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point. Each word points to its form, the near word of largest count, if that is at least
twice its own count; following forms to the last gives the root.

Scale: near words agree on all but one place, so blocks need not hold the vocabulary. For
the places [lo, hi) of the shorter word, words that agree before ``lo`` and from ``hi`` on
share a block; a pair is accepted where its first difference lies in [lo, hi), so exactly
once. There are two ranges of places at first; a block of more than ``max_block`` words is dealt again
by the halves of its range, until that is one place wide, where a block can hold
no more words than letters at two places allow. No pairs are formed in a block but the near
ones, and a task hands on one row for each word of a block: how many near words, and
the best of them. Counting words is a two-level aggregate; forms are followed by pointer
doubling, in at most log2 of the longest chain joins, and a chain at least doubles its
count with each step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, texts_of
from paylake.session import materialize_at, release, stage_scope

MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
MAX_BLOCK = 4096

#: Maximal runs of these characters are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Different words that a task holds before it hands their counts on.
HELD = 200_000


def _counts(alter, min_chars: int):
    def run(batches):
        import re
        from collections import Counter

        import pyarrow as pa

        def flushed(total):
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                              names=["word", "n"])

        words, total = re.compile(LETTERS).findall, {}
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), texts_of(b, 1)):
                # Bytes are lower-cased in A-Z only.
                for w, n in Counter(words(t.lower().decode())).items() if t else ():
                    if alter:
                        w = alter(d, w)
                    if len(w) >= min_chars:
                        total[w] = total.get(w, 0) + n
                if len(total) >= HELD:
                    yield flushed(total)
                    total = {}
        yield flushed(total)
    return run


def lexicon(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
            alter: Callable[[object, str], str] | None = None) -> DataFrame:
    """Rows ``(word, n)``: the words of all texts, A-Z lower-cased, with at least ``min_chars``
    code points and ``min_count`` occurrences. ``alter`` (id, word) may replace a word first.

    Null and empty texts have no words; rows with a repeated or null id count as they
    stand; very long texts are read whole; other columns are ignored; an empty table gives
    no words.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(_counts(alter, min_chars), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


class PositionIndex:
    """The bitsets of a block: the words of ``size`` and ``size + 1`` letters that agree
    before ``lo`` and from ``hi`` on (``hi > size``: nothing follows)."""

    def __init__(self, words: list[str], size: int, lo: int, hi: int):
        self.lo, self.stop, self.open = lo, min(hi, size), hi > size
        self.all = (1 << len(words)) - 1
        self.same = self.longer = 0
        self.at: list[dict[str, int]] = [{} for _ in range(self.stop + 1)]
        for k, w in enumerate(words):
            bit = 1 << k
            if len(w) == size:
                self.same |= bit
            else:
                self.longer |= bit
            for p in range(lo, min(self.stop + 1, len(w))):
                self.at[p][w[p]] = self.at[p].get(w[p], 0) | bit

    def near(self, q: str) -> int:
        """The words (bits) near ``q``, one of the shorter words, whose first difference lies
        in the range of places."""
        exact = inserted = self.all
        replaced = 0
        for p in range(self.lo, self.stop):
            here, shifted = self.at[p].get(q[p], 0), self.at[p + 1].get(q[p], 0)
            replaced = replaced & here | exact & ~here
            exact &= here
            inserted = inserted & shifted | exact
        # Exact so far, in a closed range: the difference comes later, in another block.
        return (replaced & self.same | inserted & self.longer) & (-1 if self.open else ~exact)


def block_matches(words: list[str], counts: list[int], size: int, lo: int, hi: int):
    """(near words, (-count, best near word)) of each word of a block, or None where there are none."""
    index = PositionIndex(words, size, lo, hi)
    found: list = [None] * len(words)

    def note(k, other):
        mark = (-counts[other], words[other])
        n, best = found[k] or (0, mark)
        found[k] = (n + 1, min(best, mark))

    for k, w in enumerate(words):
        if len(w) != size:
            continue
        bits = index.near(w)
        while bits:
            other = (bits & -bits).bit_length() - 1
            bits &= bits - 1
            note(k, other)
            if len(words[other]) != size:  # pairs of one length are seen from both sides
                note(other, k)
    return found


def _search(batches):
    import pyarrow as pa

    def matched(key, words, counts):
        out = block_matches(words, counts, *key[1:])
        return [(w, x[0], -x[1][0], x[1][1]) for w, x in zip(words, out) if x]

    def batch(rows):
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                           pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                                          names=["word", "n_near", "near_n", "near"])

    key, words, counts, out = None, [], [], []
    for b in batches:
        for block, size, lo, hi, w, n in zip(*[c.to_pylist() for c in b.columns]):
            if (block, size, lo, hi) != key:
                if len(words) > 1:
                    out += matched(key, words, counts)
                key, words, counts = (block, size, lo, hi), [], []
            words.append(w)
            counts.append(n)
        if len(out) > 10_000:
            yield batch(out)
            out = []
    if len(words) > 1:
        out += matched(key, words, counts)
    yield batch(out)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with ``size``, ``lo`` and ``hi`` and the number of their block."""
    before = F.expr("substring(word, 1, lo)")
    after = F.expr("if(hi > size, '', right(word, size - hi))")
    return rows.select(F.xxhash64("size", "lo", "hi", before, after).alias("block"), "size", "lo", "hi", "word", "n")


def near_words(words: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """Rows ``(word, n_near, near_n, near)`` of the words ``(word, n)`` that have a near word:
    how many, and the near word of largest ``n`` (ties: the smallest in code-point
    order) with that ``n``. ``word`` must be unique; null words are left out."""
    spark = words.sparkSession
    size = F.char_length("word")
    # As one of the shorter words, and as one of the longer.
    sized = words.filter("word IS NOT NULL AND word <> ''").select("word", "n", F.explode(F.array(size, size - 1)).alias("size"))
    ranges = F.explode(F.array(F.struct(F.lit(0).alias("lo"), F.expr("int(size div 2)").alias("hi")),
                               F.struct(F.expr("int(size div 2)").alias("lo"), (F.col("size") + 1).alias("hi"))))
    rows = _dealt(sized.select("word", "n", "size", ranges.alias("r")).select("word", "n", "size", "r.lo", "r.hi").filter("lo < hi"))
    blocks = []
    while True:
        rows, _ = materialize_at(rows, "spelling-blocks")
        large, large_at = materialize_at(rows.filter("hi - lo > 1").groupBy("block").count().filter(F.col("count") > max_block)
                                         .select("block"), "spelling-large")
        if not large.head(1):
            release(spark, large_at)
            blocks.append(rows)
            break
        blocks.append(rows.join(large, "block", "left_anti"))
        halves = F.explode(F.array(F.struct("lo", F.expr("int((lo + hi) div 2)").alias("hi")),
                                   F.struct(F.expr("int((lo + hi) div 2)").alias("lo"), "hi")))
        rows = _dealt(rows.join(large, "block", "left_semi").select("word", "n", "size", halves.alias("r"))
                      .select("word", "n", "size", "r.lo", "r.hi"))
    every = blocks[0]
    for more in blocks[1:]:
        every = every.unionByName(more)
    found = (every.repartition("block").sortWithinPartitions("block", "size", "lo", "hi", "word")
             .mapInArrow(_search, "word string, n_near long, near_n long, near string"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """Rows ``(word, root)`` for rows ``(word, form)``: the end of the chain of forms that starts
    at the word. Every chain must end."""
    spark = forms.sparkSession
    links, at = materialize_at(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped, stepped_at = materialize_at(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                                     F.col("further").isNotNull().alias("moved")), "spelling-forms")
        release(spark, at)
        links, at = stepped.select("word", "root"), stepped_at
        if not stepped.filter("moved").head(1):
            return links


def spelling_groups(words: DataFrame, ratio: float = RATIO, max_block: int = MAX_BLOCK) -> DataFrame:
    """Rows ``(word, form, root, n, n_near, form_n)``, one for each word of ``words``
    ``(word, n)``, such as :func:`lexicon` gives.

    - ``n_near``: near words, 0 if none;
    - ``form``: the near word of largest ``n`` (ties: the smallest in code-point order) if
      that ``n`` is at least ``ratio`` (over 1) times the word's, else null; ``form_n``: its ``n``;
    - ``root``: forms followed to the last; the word itself if it has none;
    - an empty table gives none; columns other than these two are ignored.
    """
    if ratio <= 1:
        raise ValueError("a ratio of 1 or less lets forms run in circles")
    spark = words.sparkSession
    with stage_scope(spark) as keep:
        words, _ = materialize_at(words.select("word", "n"), "spelling-words")
        near, _ = materialize_at(near_words(words, max_block), "spelling-near")
        formed, at = materialize_at(words.join(near, "word", "left")
                                    .withColumn("form", F.when(F.col("near_n") >= ratio * F.col("n"), F.col("near")))
                                    .select("word", "form", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                            F.when(F.col("form").isNotNull(), F.col("near_n")).alias("form_n")), "spelling-formed")
        keep(at)
    last = roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
