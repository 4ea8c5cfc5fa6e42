"""Versions of a table folder, committed one after the other.

A table folder holds data under names unique to the run that wrote them and
``versions/<n>``, one small JSON file for each version that says which of these folders the
version consists of. A commit is the appearance of that file, by a rename that
fails if the file is there already: it happens at once or not at all, and of two writers that
started from the same version one gets it and the other a :class:`CommitConflict`.
Nothing that a committed version names is ever written again.

The rename is atomic where the filesystem's is (HDFS, viewfs); a local filesystem is for tests.
With a table format that has MERGE and commits of its own, it replaces this.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed the version that this one was to become."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, in order."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/versions")
    if not fs.exists(p):
        return []
    return sorted(int(x) for x in (s.getPath().getName() for s in fs.listStatus(p)) if x.isdigit())


def read_version(spark: SparkSession, root: str, version: int) -> dict:
    fs, p = _fs(spark, f"{root.rstrip('/')}/versions/{version}")
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def last_version(spark: SparkSession, root: str) -> tuple[int | None, dict]:
    """Number and content of the last committed version; ``(None, {})`` before the first."""
    found = versions(spark, root)
    return (found[-1], read_version(spark, root, found[-1])) if found else (None, {})


def commit(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Make ``content`` the version ``version``; :class:`CommitConflict` if there is one."""
    sc, root = spark.sparkContext, root.rstrip("/")
    jvm = sc._jvm
    fs, draft = _fs(spark, f"{root}/versions/.draft-{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(f"{root}/versions/{version}")
    out = fs.create(draft, True)
    out.write(json.dumps(content).encode())
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(final):
            raise CommitConflict(f"{root}: version {version} was committed by another writer") from e
        raise
