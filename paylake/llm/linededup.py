"""Line de-duplication across documents.

Method: explode the normalised lines of every document, hash them, count the
distinct documents of each hash, drop the lines over the threshold from every
document but the first, and reassemble the others by position.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased. Only keys of at least ``min_chars`` code points can be dropped.

Scale: the exploded side holds a 16-byte hash and an id, at most one row for each
key of a row, and is written once to the shared folder. Counting is a
two-level aggregate (distinct (hash, id) first), so a line that a third of all
documents share is spread over the cluster until only counts are left. The hashes
to drop go to their documents by two equi-joins, which AQE may split when
a key is hot. No text is exploded; it moves once, for the join by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import NULL_ID, SPACE, bounded_batches, texts_of
from paylake.session import materialize

MIN_CHARS = 10
MIN_DOCS = 2


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key; ``None`` if the key is too short."""
    import xxhash

    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _hashes(min_chars: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, bodies, hashes = [], [], []
            for d, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b, 2)):
                if t:
                    found = sorted({line_hash(x, min_chars) for x in t.split(b"\n")} - {None})
                    hashes += found
                    ids += [d] * len(found)
                    bodies += [h] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array(ids, pa.int64()), pa.array(bodies, pa.int64())],
                                             names=["line_hash", "id", "body"])
    return run


def _reassemble(min_chars: int, text_at: int):
    """The batch's last column holds the hashes to drop; the others but the text pass through."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            kept, total, dropped = [], [], []
            for t, gone in zip(texts_of(b, text_at), b.column(b.num_columns - 1).to_pylist()):
                lines = (t or b"").split(b"\n")
                total.append(len(lines))
                if gone:
                    gone = set(gone)
                    stay = [x for x in lines if line_hash(x, min_chars) not in gone]
                    dropped.append(len(lines) - len(stay))
                    t = b"\n".join(stay)
                else:
                    dropped.append(0)
                kept.append(t)
            columns = [*b.columns[:-1], pa.array(total, pa.int64()), pa.array(dropped, pa.int64())]
            columns[text_at] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:-1], "n_lines", "n_dropped"])
    return run


def mark(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
         min_docs: int = MIN_DOCS) -> DataFrame:
    """The columns ``keep`` as ``k_<name>`` with what stays of the text, then ``n_lines`` and
    ``n_dropped``; one row for each input row. See :func:`dedup_lines`."""
    bounded_batches(docs.sparkSession)
    keep = list(dict.fromkeys([*keep, text_col]))
    rows = docs.select(*[(F.col(c).cast("string") if c == text_col else F.col(c)).alias("k_" + c) for c in keep],
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("body"))
    keys = materialize(rows.select("id", "body", "k_" + text_col)
                       .mapInArrow(_hashes(min_chars), "line_hash binary, id long, body long"), "line-hashes")
    # Written out, so that the join below has a shuffle on both sides and AQE may split a hot line.
    shared = materialize(keys.groupBy("line_hash").agg(F.count_distinct("id").alias("n"), F.min("id").alias("first"))
                         .filter(F.col("n") >= min_docs).select("line_hash", "first"), "shared-lines")
    # By id and text, so that rows with one (or no) id don't gather all their lines in one place.
    gone = (keys.join(shared, "line_hash").filter(F.col("id") != F.col("first"))
            .groupBy("id", "body").agg(F.collect_set("line_hash").alias("gone")))
    rows = rows.join(gone, ["id", "body"], "left").drop("id", "body")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("gone").schema)
    return rows.mapInArrow(_reassemble(min_chars, keep.index(text_col)), f"{kinds}, n_lines long, n_dropped long")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows ``(<id_col>, text, n_lines, n_dropped)``, one for each input row.

    ``text`` is what stays of the text; ``n_lines`` counts lines before dropping.

    - null or empty text: one empty line, which stays; ``text`` is then empty;
    - very long texts and lines are read whole;
    - a text whose lines all go: empty text, ``n_dropped = n_lines``;
    - repeated ids: the rows are one document, so they don't make a line shared;
    - null id: one document that sorts after every other;
    - other columns are ignored, whatever their names; an empty table gives none.
    """
    out = mark(docs, [id_col], id_col, text_col, **options)
    return out.select(F.col("k_" + id_col).alias(id_col), F.coalesce("k_" + text_col, F.lit("")).alias("text"), "n_lines", "n_dropped")


def without_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` (all rows and columns) with what stays of each text; ``chars_col``, if
    there is one, becomes the text's length. The cases of :func:`dedup_lines` hold, but a
    null text stays null."""
    out = mark(docs, docs.columns, id_col, text_col, **options)
    new = {chars_col: F.length("k_" + text_col).cast(docs.schema[chars_col].dataType)} if chars_col in docs.columns else {}
    return out.select(*[new.get(c, F.col("k_" + c)).alias(c) for c in docs.columns])
