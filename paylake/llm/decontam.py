"""Benchmark decontamination.

Method: a broadcast hash set of the normalised n-grams of the test items; the
words of every document are scanned against it, hits are verified word by word,
and the hit spans or the whole documents can be removed.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is
``n`` consecutive words of an item; an item of fewer words (but not none) is one
window. A document word inside any occurrence of a window is hit.

Scale: one pass over the documents without a shuffle. The set is broadcast in
blocks of ``max_windows`` (window, item) pairs on average, the number of which is
counted first and which are dealt by hash; each block is one more pass, so a larger benchmark costs time and
not memory, and no pair is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, texts_of
from paylake.session import materialize

WINDOW = 10
MAX_WINDOWS = 1_000_000

#: Bytes that belong to words (digits, a-z and all of non-ASCII); others become blanks.
_WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def blanked(text: bytes | None) -> bytes:
    """Lower-cased text of the same length whose non-word bytes are blanks."""
    return (text or b"").lower().translate(_WORD_BYTES)


def _windows(n: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            out, items = [], []
            for item, t in zip(b.column(0).to_pylist(), texts_of(b, 1)):
                w = blanked(t).split()
                found = {b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
                out += found
                items += [item] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(items, pa.string())],
                                             names=["win", "item"])
    return run


class Scanner:
    """The windows of one block, ready for lookups: words as numbers, and each
    window's number sequence with its items."""

    def __init__(self, pairs):
        import numpy as np

        self.vocab: dict[bytes, int] = {}
        self.items: dict[int, dict[bytes, list[str]]] = {}
        for win, item in pairs:
            words = bytes(win).split()
            seq = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int32)
            self.items.setdefault(len(words), {}).setdefault(seq.tobytes(), []).append(item)

    def scan(self, words: list[bytes]):
        """The starts and ends (in words) of all occurrences, and their items."""
        from itertools import repeat

        import numpy as np

        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int32, len(words))
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        starts, ends, items = [], [], set()
        for n, wins in self.items.items():
            if len(words) < n:
                continue
            for i in np.flatnonzero(known[n:] - known[:-n] == n).tolist():  # all n words occur in some window
                got = wins.get(ids[i:i + n].tobytes())
                if got is not None:
                    starts.append(i)
                    ends.append(i + n)
                    items.update(got)
        return starts, ends, items


def _scan(held, text_at: int):
    """held: a broadcast of the block's (window, item) pairs. The batch's last columns are
    starts, ends and items; the others pass through."""
    def run(batches):
        import pyarrow as pa

        scanner = Scanner(held.value)
        for b in batches:
            n, starts, ends, items = b.num_columns - 3, [], [], []
            for t, s, e, i in zip(texts_of(b, text_at), *(b.column(n + k).to_pylist() for k in range(3))):
                s2, e2, i2 = scanner.scan(blanked(t).split())
                starts.append(s + s2)
                ends.append(e + e2)
                items.append(sorted(i2.union(i)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
                 pa.array(items, pa.list_(pa.string()))], names=b.schema.names)
    return run


def _verdict(text_at: int, cut: bool):
    """Unites the occurrences and, if asked, cuts their words out of the text."""
    def run(batches):
        import re

        import numpy as np
        import pyarrow as pa

        for b in batches:
            n, n_words, n_hit, clean = b.num_columns - 3, [], [], []
            for t, starts, ends in zip(texts_of(b, text_at), b.column(n).to_pylist(), b.column(n + 1).to_pylist()):
                norm = blanked(t)
                words = norm.split()
                n_words.append(len(words))
                if not starts:
                    n_hit.append(0)
                    clean.append(t)
                    continue
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, ends, -1)
                hit = np.cumsum(edge)[:-1] > 0
                n_hit.append(int(hit.sum()))
                keep, at = [], 0
                if cut:
                    spans = [m.span() for m in re.finditer(rb"[^ ]+", norm)]
                    flips = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]))).reshape(-1, 2)
                    for first, last in flips.tolist():
                        keep.append(t[at:spans[first][0]])
                        at = spans[last - 1][1]
                clean.append(b"".join(keep) + t[at:])
            text = [pa.array(clean, pa.binary()).cast(pa.string())] if cut else []
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), b.column(n + 2), *text],
                names=[*b.schema.names[:n], "n_words", "n_hit", "items", *["clean_text"] * cut])
    return run


def mark(docs: DataFrame, bench: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS, cut: bool = False) -> DataFrame:
    """The columns ``keep`` as ``k_<name>``, then ``n_words, n_hit, items`` and, with
    ``cut``, ``clean_text``; one row for each input row. See :func:`decontaminate`."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                         F.col(item_text).cast("string").alias("body"))
    pairs = materialize(items.mapInArrow(_windows(window), "win binary, item string").distinct(), "bench-windows")
    blocks = max(1, -(-pairs.count() // max_windows))
    keep = list(dict.fromkeys([*keep, text_col]))
    text_at = keep.index(text_col)
    rows = docs.select(*[(F.col(c).cast("string") if c == text_col else F.col(c)).alias("k_" + c) for c in keep])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rows = rows.select("*", F.array().cast("array<int>").alias("starts"), F.array().cast("array<int>").alias("ends"),
                       F.array().cast("array<string>").alias("items"))
    for k in range(blocks):
        # by both, so that a window which many items share is in no block with all of them
        part = pairs.filter(F.pmod(F.xxhash64("win", "item"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast([(bytes(r.win), r.item) for r in part.collect()])
        rows = rows.mapInArrow(_scan(held, text_at), f"{kinds}, starts array<int>, ends array<int>, items array<string>")
        if k + 1 < blocks:  # one block's set at a time in the workers
            rows = materialize(rows, "bench-hits")
    return rows.mapInArrow(_verdict(text_at, cut), f"{kinds}, n_words long, n_hit long, items array<string>" + ", clean_text string" * cut)


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows ``(<id_col>, n_words, n_hit, items, contaminated, clean_text)``, one for
    each input row.

    ``items`` are the ids (text, sorted) of the items with an occurring window;
    ``clean_text`` is the text without the hit spans (from the first to the last hit
    word of a run), unchanged where nothing is hit.

    - very long texts are read whole;
    - null or wordless text: no words, not contaminated, ``clean_text`` as it came;
    - null or wordless items have no window; a null item id is the text ``null``;
    - repeated rows of either table: each document row is answered, and an item
      counts once; empty tables: no rows, or nothing contaminated;
    - other columns are ignored, whatever their names.
    """
    out = mark(docs, bench, [id_col], text_col, cut=True, **options)
    return out.select(F.col("k_" + id_col).alias(id_col), "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"), "clean_text")


def without_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", remove: str = "documents", **options) -> DataFrame:
    """``docs`` (all columns) without the documents that hold a window, or with
    ``remove="spans"`` with the hit spans cut out of their texts. The cases of
    :func:`decontaminate` hold; columns of any name pass through."""
    out = mark(docs, bench, docs.columns, text_col, cut=remove == "spans", **options)
    if remove != "spans":
        out = out.filter("n_hit = 0")
    return out.select(*[(F.col("clean_text") if remove == "spans" and c == text_col else F.col("k_" + c)).alias(c) for c in docs.columns])
