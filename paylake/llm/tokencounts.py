"""Token counts.

Method: an exact length histogram. Documents are aggregated by encoded length, and
suffix sums over the lengths answer totals, quantiles and truncated totals for every
context limit at once.

Scale: one pass over the texts; a task folds its batches into counts by length
before the shuffle, so that what moves is lengths, not documents. The sums over lengths go in
two steps (blocks of lengths, then within each block), so that no task sees all lengths.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, texts_of
from paylake.session import materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that this public vocabulary splits texts with (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What ``\s`` means to the pattern: the characters with the property White_Space (fixed values).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space of so many characters are encoded apart.
LONG_BLANKS = 4096
#: Lengths in a block of the suffix sums.
BLOCK = 256


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """A vocabulary file (base64 piece and rank on a line), read by the driver and
    broadcast: its size doesn't depend on the data."""
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(state: dict):
    """The tokenizer of ``state["ranks"]``; kept in ``state``, which a worker's tasks share."""
    import tiktoken

    if "encoder" not in state:
        state["encoder"] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=state["ranks"], special_tokens={})
    return state["encoder"]


def _whole(state: dict):
    """The same vocabulary for a text that is one piece of the pattern."""
    import tiktoken

    if "whole" not in state:
        state["whole"] = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=state["ranks"], special_tokens={})
    return state["whole"]


def encoded_length(state: dict, text: str, long: int = LONG_BLANKS) -> int:
    """Tokens of a text. Of a run of white space the pattern makes one piece of all but the last
    character, which begins what follows (at the end of the text: of all). On long runs
    its look-ahead would need a stack as deep as the run, so these are cut out first."""
    enc = encoder(state)
    # A long run covers a position divisible by its least length.
    if not any(c.isspace() for c in text[::long]):
        return len(enc.encode_ordinary(text))
    total = at = 0
    for run in re.finditer(f"[{WHITE_SPACE}]{{{long},}}", text):
        end = run.end() - (run.end() < len(text))
        total += len(enc.encode_ordinary(text[at:run.start()])) + len(_whole(state).encode_ordinary(text[run.start():end]))
        at = end
    return total + len(enc.encode_ordinary(text[at:]))


def _lengths(held):
    def run(batches):
        counts = Counter()
        for b in batches:
            counts.update(encoded_length(held.value, (t or b"").decode("utf-8", "replace")) for t in texts_of(b, 0))
            if len(counts) > 100_000:
                yield _batch(counts)
                counts.clear()
        yield _batch(counts)

    def _batch(counts):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                          names=["length", "n_docs"])
    return run


def length_histogram(docs: DataFrame, ranks: dict[bytes, int], text_col: str = "text") -> DataFrame:
    """``(length, n_docs)``: how many documents have each encoded length. Null and
    empty texts have length 0; every row counts, repeated ones too; an empty table
    gives no rows. Strings of special tokens in a text are ordinary text."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})
    rows = docs.select(F.col(text_col).cast("string").alias("body"))
    return (rows.mapInArrow(_lengths(held), "length long, n_docs long")
            .groupBy("length").agg(F.sum("n_docs").alias("n_docs")))


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """For every length L of the histogram, as a context limit:

    ``n_docs`` of that length, ``docs_over`` and ``tokens_over`` (documents longer than L
    and their tokens), ``total_docs``, ``total_tokens``, ``truncated_tokens`` (all tokens
    if texts are cut at L) and ``quantile`` (the share of documents of length L or less).
    A limit between two lengths L < x < M has L's ``docs_over``, and
    ``truncated_tokens`` of L plus ``(x - L) * docs_over``.
    """
    h = histogram.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"),
                         F.floor(F.col("length") / block).alias("block"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = (h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
              .select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"],
                      *[F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"]))
    after = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = h.join(blocks, "block").select(
        "length", "n_docs",
        (F.coalesce(F.sum("n_docs").over(after), F.lit(0)) + F.col("d_later")).alias("docs_over"),
        (F.coalesce(F.sum("tokens").over(after), F.lit(0)) + F.col("t_later")).alias("tokens_over"),
        F.col("d_all").alias("total_docs"), F.col("t_all").alias("total_tokens"))
    return out.select("*", (F.col("total_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("truncated_tokens"),
                      (1 - F.col("docs_over") / F.col("total_docs")).alias("quantile"))


def answer(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``(limit, docs_over, truncated_tokens)`` for any limits, from the rows of :func:`suffix_sums`."""
    asked = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "limit long")
    best = sums.select(F.explode(F.array(*[F.when(F.col("length") <= x, F.lit(int(x))) for x in limits])).alias("limit"),
                       F.struct("length", "docs_over", "truncated_tokens").alias("at")).filter("limit is not null")
    best = best.groupBy("limit").agg(F.max("at").alias("at"))
    total = sums.agg(F.max("total_docs").alias("total"))
    return asked.join(best, "limit", "left").select(
        "limit", F.coalesce(F.col("at.docs_over"), total.select("total").scalar(), F.lit(0)).alias("docs_over"),
        F.coalesce(F.col("at.truncated_tokens") + (F.col("limit") - F.col("at.length")) * F.col("at.docs_over"),
                   F.col("limit") * total.select("total").scalar(), F.lit(0)).alias("truncated_tokens"))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """:func:`suffix_sums` of the documents' histogram. Other columns are ignored; an empty table gives no rows."""
    histogram = materialize(length_histogram(docs, read_ranks(vocabulary), text_col), "lengths")
    return suffix_sums(histogram)
