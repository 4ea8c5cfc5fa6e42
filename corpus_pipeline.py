"""The corpus pipeline: quality rules, line de-duplication, near-duplicates,
decontamination and packing over the documents of a data directory.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all
documents which the stage before kept; all but the last return the columns of
documents. :func:`run` applies them in order and cuts the lineage after each by
a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import decontam, linededup, packing, rules, simhash
from paylake.llm.common import read
from paylake.session import materialize_at, release, stage_scope

#: No SQL: the decision list, the fingerprints and the packing are not expressible in
#: it; ``tests/llm`` holds the pipeline against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    judged, _ = rules.judge(docs, read(spark, sf_dir, "labels"), tuple(docs.columns))
    return judged.filter("kept").select(*[F.col("k_" + c).alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` follows the text."""
    return linededup.without_shared_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontam.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the remaining documents."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", benchmarks), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage stages goes when its result is written, and that
    result when the next one is."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with stage_scope(spark) as keep:
            docs, path = materialize_at(stage(spark, docs, sf_dir), f"stage-{name}")
            keep(path)
        if last:
            release(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
