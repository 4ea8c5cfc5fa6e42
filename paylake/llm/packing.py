"""Best-fit packing.

Method: conflict-constrained best fit. Pieces go, the largest first, into the open bin
of the least sufficient residual. Open bins are ordered by residual, and bitmaps say which
bins hold a source or a duplicate cluster; from the first residual that is large
enough the search goes on to its successors until one has a compatible bin (no common
source, no common cluster): the tightest one, the oldest of ties. Else a bin is opened.
The bitmaps are over bins: a residual's bins without those of the piece's source and
cluster are found at once, however many conflict.

Sizes are words (``[^\\x20\\x09-\\x0D]+``) and one separator per document. A document
over the capacity is cut into pieces of ``capacity``, of which the last may be smaller.
A cluster is the texts that are equal after lower-casing A-Z and folding white space
(exact copies; near copies of different sources may share a bin).

Scale: pieces are dealt by hash into shards of ``SHARD_BINS`` full bins on average, or of
``SHARD_PIECES`` pieces if they are small, whatever the input; each shard is packed alone, so a hot source or cluster is spread
over all shards. Only sizes and ids move, not texts. All pieces get a bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import NULL_ID, bounded_batches, texts_of
from paylake.session import materialize

CAPACITY = 2048
SHARD_BINS = 512
SHARD_PIECES = 1 << 17


def pack(pieces: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each (size, source, cluster); numbers below 0 conflict with nothing."""
    order = sorted(range(len(pieces)), key=lambda k: (-pieces[k][0], k))
    having: dict[tuple[str, int], int] = {}  # the bins (bits) that hold a source or a cluster
    left = [0] * (capacity + 1)  # the open bins (bits) of each residual
    open_left = 0  # the residuals (bits) that open bins have
    placed, bins = [(0, 0)] * len(pieces), 0
    for k in order:
        size, source, cluster = pieces[k]
        marks = [("source", source)] * (source >= 0) + [("cluster", cluster)] * (cluster >= 0)
        taken = 0
        for mark in marks:
            taken |= having.get(mark, 0)
        free, residual, later = 0, capacity, open_left >> size
        while later:
            residual = size + (later & -later).bit_length() - 1
            free = left[residual] & ~taken
            if free:
                break
            later &= later - 1
        if free:
            bit = free & -free
            left[residual] ^= bit
            if not left[residual]:
                open_left ^= 1 << residual
        else:
            residual, bit, bins = capacity, 1 << bins, bins + 1
        placed[k] = bit.bit_length() - 1, capacity - residual
        for mark in marks:
            having[mark] = having.get(mark, 0) | bit
        if residual > size:
            left[residual - size] |= bit
            open_left |= 1 << (residual - size)
    return placed


def _pieces(capacity: int):
    def run(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            ids, sources, clusters, nth, starts, sizes = [], [], [], [], [], []
            for d, src, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b, 2)):
                words = (t or b"").lower().split()
                cluster = xxhash.xxh3_128_digest(b" ".join(words))
                size = len(words) + 1
                for k, start in enumerate(range(0, size, capacity)):
                    ids.append(d)
                    sources.append(src)
                    clusters.append(cluster)
                    nth.append(k)
                    starts.append(start)
                    sizes.append(min(capacity, size - start))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sources, pa.string()), pa.array(clusters, pa.binary()),
                 *(pa.array(x, pa.int64()) for x in (nth, starts, sizes))],
                names=["id", "source", "cluster", "piece", "start", "n_tokens"])
    return run


def _pack(capacity: int, by_source: bool):
    def run(pdf):
        # One order whatever order the rows came in, so that a lost task gives the same bins again.
        pdf = pdf.sort_values(["n_tokens", "id", "piece", "source", "cluster"], ascending=[False, True, True, True, True],
                              kind="stable").reset_index(drop=True)
        source = pdf["source"].fillna("").factorize()[0] if by_source else [-1] * len(pdf)
        cluster, _ = pdf["cluster"].factorize()
        alone = pdf.groupby(cluster)["cluster"].transform("size") == 1  # conflicts with nothing
        cluster = [-1 if a else int(c) for a, c in zip(alone, cluster)]
        placed = pack(list(zip(pdf["n_tokens"].tolist(), map(int, source), cluster)), capacity)
        pdf["bin"] = [pdf["shard"].iloc[0] * (1 << 24) + b for b, _ in placed] if len(pdf) else []
        pdf["offset"] = [o for _, o in placed]
        return pdf[["bin", "offset", "id", "piece", "start", "n_tokens", "source"]]
    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   capacity: int = CAPACITY, by_source: bool = True, shard_bins: int = SHARD_BINS) -> DataFrame:
    """Rows ``(bin_id, bin_offset, <id_col>, piece, start_word, n_tokens, source)``, one for each piece.

    ``bin_id`` is unique over all shards; pieces of a bin don't overlap. No bin holds two
    pieces of one source (if ``by_source``) or of one duplicate cluster.

    - null and wordless texts are a piece of one token (the separator);
    - a null source is a source of its own, the empty one; null ids are packed like others;
    - repeated rows are copies of each other, hence in different bins;
    - very long texts are cut into pieces, all of which are packed;
    - other columns are ignored, whatever their names; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("body"))
    pieces = materialize(rows.mapInArrow(
        _pieces(capacity), "id long, source string, cluster binary, piece long, start long, n_tokens long"), "pieces")
    total, n = pieces.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(1, -(-total // (capacity * shard_bins)), -(-n // SHARD_PIECES))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "piece", F.monotonically_increasing_id()), F.lit(shards)))
    out = dealt.groupBy("shard").applyInPandas(
        _pack(capacity, by_source), "bin long, offset long, id long, piece long, start long, n_tokens long, source string")
    return out.select(F.col("bin").alias("bin_id"), F.col("offset").alias("bin_offset"),
                      F.nullif("id", F.lit(NULL_ID)).alias(id_col), "piece", F.col("start").alias("start_word"), "n_tokens", "source")
