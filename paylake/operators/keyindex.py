"""Where the keys of a table are: a bucketed index from key to partition.

The index is a list of Parquet folders of ``(key, txn_date)``, each dealt by key over the same
number of buckets and sorted in them. Spark joins such a folder with a batch that is
dealt alike without moving the index: the batch's keys are shuffled, the stored ones
are read where they lie.

Each publication adds one folder with the keys it inserts, so folders are never written
twice; from ``COMPACT`` folders on, the next publication writes all of them as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new index; a deployment takes about one for each 100 MB of keys.
BUCKETS = 8
COMPACT = 16


def _table(path: str) -> str:
    return "paylake_keys_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")


def write_folder(keys: DataFrame, root: str, key: str, buckets: int) -> str:
    """``keys`` as a new folder of the index; returns its name. One task writes one bucket."""
    name = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/index/{name}"
    table = _table(path)
    (keys.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet")
     .saveAsTable(table))
    keys.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay
    return name


def open_folder(spark: SparkSession, root: str, name: str, key: str, buckets: int) -> DataFrame:
    """One folder as a bucketed table of the session's catalog."""
    path = f"{root.rstrip('/')}/index/{name}"
    table = _table(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (`{key}` STRING, txn_date DATE) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def close_folders(spark: SparkSession, root: str, names: list[str]) -> None:
    """Forget the catalog tables of :func:`open_folder`; the files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {_table(f'{root}/index/{name}')}")


def find(spark: SparkSession, root: str, names: list[str], keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """``(key, txn_date)`` of the stored rows whose key is in ``keys`` (unique). The index isn't
    shuffled: the keys are dealt by the index's own partitioning, once for all folders."""
    dealt = keys.select(key).repartition(buckets, key)
    out = None
    for name in names:
        # A merge join, so that no folder's size makes the planner deal the stored keys.
        hit = open_folder(spark, root, name, key, buckets).join(dealt.hint("merge"), key).select(key, "txn_date")
        out = hit if out is None else out.unionByName(hit)
    return spark.createDataFrame([], f"{key} string, txn_date date") if out is None else out
