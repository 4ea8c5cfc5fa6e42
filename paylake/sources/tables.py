"""Readers for Parquet tables and raw CSV feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.text import null_tokens
from paylake.schemas import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory (``<dir>/<name>.parquet``), listed anew on every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def normalise_raw(df: DataFrame) -> DataFrame:
    """Turn the CSV null tokens (``N/A``, ``NaN``, ``NULL``, ...) into nulls in
    every raw column; other columns pass through."""
    return df.select(*[null_tokens(F.col(c)).alias(c) if c in RAW_COLUMNS else F.col(c) for c in df.columns])


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scan a raw transaction CSV with every column as a string.

    Columns go by the header's names, in any order; columns that the feed lacks
    are null, others are ignored. Files of one feed must share a header (a file
    with another one raises an error). Quotes inside quoted text are doubled.
    With ``multi_line`` (the default) quoted text may hold line breaks, and a file
    is one split; without it large files are split, for feeds that have none.

    ``ingest_seq`` records the input order (file number, path, split offset, row),
    which first-copy-wins de-duplication needs: Spark does not schedule splits in
    file order, and part numbers have no fixed width.
    """
    def reader():
        return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)

    names = reader().csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = reader().schema(schema).option("enforceSchema", False).csv(path)
    file = F.col("_metadata.file_path")
    number = F.regexp_extract(file, r"part-(\d+)[^/]*$", 1).try_cast("long")
    seq = F.struct(number.alias("part"), file.alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row"))
    raw = [F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
    return normalise_raw(df.select(seq.alias("ingest_seq"), *raw))


def write_raw_csv(df: DataFrame, path: str, order: str = "ingest_seq", columns: list[str] = RAW_COLUMNS) -> None:
    """Write a raw feed as headered CSV (the original input format), in
    ``order``: range-partitioned (as many ranges as shuffle partitions,
    adjacent ones merged by AQE up to the advisory size, so file sizes
    follow the data), sorted inside each file, so the file names and the
    row positions reproduce the input order. Whitespace is kept as is
    (Spark's CSV writer trims it by default); quotes are doubled."""
    (df.repartitionByRange(order).sortWithinPartitions(order).select(*columns)
     .write.mode("errorifexists").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
