"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters ``[\x20\x09-\x0D]`` that separate words.
SPACE = b" \t\n\x0b\x0c\r"
#: The same set as a Java regular expression, for Spark expressions.
SPACE_RE = r"[\x20\x09-\x0D]"
#: Texts that a task hands to Python at once.
BATCH_BYTES = 4 << 20
#: Stand-in for a null document id: it sorts after every other id.
NULL_ID = (1 << 63) - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(id_col: Column, mod: int) -> Column:
    """``crc32(id as text) mod n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


def bounded_batches(spark: SparkSession) -> None:
    """Lets Arrow batches between the JVM and Python hold ``BATCH_BYTES`` (one row more
    at most), however long the texts are, for the rest of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts_of(batch, column: int) -> list:
    """A batch's string column as UTF-8 bytes (null: ``None``), not decoded."""
    import pyarrow as pa

    col = batch.column(column)
    binary = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(binary).to_pylist()
