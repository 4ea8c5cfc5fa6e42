"""The batch job: raw feed -> clean, enriched, flagged rows -> fact + audit.

Physical shape of ``transform``: one shuffle on ``transaction_id``
(de-duplication), one small histogram aggregate for the exact p95, and one shuffle
on (sender, time bucket) for the previous-event window. Everything else is narrow,
and a query computes only the branches it uses. ``run_batch``, where several
branches read the same rows, writes the de-duplicated and the clean stage once and
derives everything else from the written stages, so no stage runs twice.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import materialize_at, release

from paylake.operators import clean as C
from paylake.operators import enrich as E
from paylake.operators import fact as FT
from paylake.operators import quality as Q
from paylake.operators.flags import SPLIT_SECONDS, flag_high_value, flag_rapid_succession, hot_hours
from paylake.operators.report import quality_report, summary_by_type, top_regions
from paylake.plans.incremental import refresh_marts
from paylake.plans.publish import register_staging
from paylake.plans.staging import stg_transactions


@dataclass
class Transformed:
    classified: DataFrame   # de-duplicated rows, typed, with reject_reason
    clean: DataFrame        # clean, enriched, flagged rows
    funnel: DataFrame       # reject_reason -> rows
    staged: str | None = None  # folder of the staged de-dup frame, if staged

    def report(self) -> DataFrame:
        return quality_report(self.funnel, self.clean)


def transform(raw: DataFrame, stage: bool = False, split_seconds: int = SPLIT_SECONDS, numbered: bool = True) -> Transformed:
    """Clean, enrich and flag a raw feed. Lazy: nothing runs until a result is used.

    With ``stage`` the de-duplicated, typed frame is written once to the shared
    checkpoint folder and all branches read that; the caller releases
    ``staged`` when they are done (see :func:`run_batch`). Its plan of two phases needs input
    numbers that are unique; without ``numbered`` they may repeat.
    """
    staged = None
    if stage and not numbered:
        classified, staged = materialize_at(C.classify(raw), "classified")
    elif stage:
        # The list of repeated ids first: with its size known, a small one is broadcast and
        # the rows are not shuffled.
        repeated, listed = materialize_at(C.repeated_ids(raw), "repeated-ids")
        classified, staged = materialize_at(C.classify(raw, repeated), "classified")
        release(raw.sparkSession, listed)
    else:
        classified = C.classify(raw)
    rows = C.clean_rows(classified)
    hot = hot_hours(rows, split_seconds) if stage else None
    rows = E.enrich(rows)
    rows = flag_rapid_succession(rows, split_seconds=split_seconds, hot=hot)
    rows = flag_high_value(rows)
    rows = E.add_total_debit(rows)
    return Transformed(classified, rows, C.reject_funnel(raw, classified), staged)


def rule_results(clean: DataFrame, stg: DataFrame, report: DataFrame) -> DataFrame:
    """``(rule, failures)`` for every data test; 0 is a pass."""
    n = lambda df, rule: df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(rule).alias("rule"), "failures")
    nulls = Q.null_counts(stg, ["transaction_id", "transaction_amount_ghs", "transaction_timestamp", "amount_bucket"])
    out = nulls.select(F.concat(F.lit("not_null_"), F.col("column_name")).alias("rule"), F.col("null_rows").alias("failures"))
    for rule, df in (("unique_transaction_id", Q.duplicate_keys(stg)), ("accepted_operator", Q.bad_operators(stg)),
                     ("accepted_status", Q.bad_statuses(stg)), ("accepted_type_label", Q.bad_type_labels(clean)),
                     ("positive_amount", Q.non_positive_amounts(clean)), ("total_debit", Q.total_debit_mismatch(clean)),
                     ("report_bounds", Q.report_bounds(report))):
        out = out.unionByName(n(df, rule))
    return out


def run_batch(spark: SparkSession, raw: DataFrame, out_dir: str, run_id: str) -> dict:
    """One whole run, by files: clean stage -> fact version -> marts, summaries and
    data tests -> audit row (last, when everything else is published).

    ``out_dir`` should be on the shared filesystem of the cluster. Under it:
    ``fact`` and ``marts`` (versions), ``summary_by_type``, ``top_regions``, ``rules``, ``audit``
    and the run's ``stages``. Fact and audit exist, empty, before the first rows come; a
    run that is repeated leaves the same rows and one audit row. Runs at the same time merge
    one after the other.
    """
    fact_root, audit_path = os.path.join(out_dir, "fact"), os.path.join(out_dir, "audit")
    FT.create_fact(spark, fact_root)
    FT.create_audit(spark, audit_path)
    t = transform(raw, stage=True)
    stage = os.path.join(out_dir, "stages", run_id)
    clean_path, funnel_path = os.path.join(stage, "clean"), os.path.join(stage, "funnel")
    try:
        FT.write_by_date(t.clean, clean_path)
        t.funnel.write.mode("overwrite").parquet(funnel_path)
    finally:  # everything derived from the staged de-dup frame is written now
        release(spark, t.staged)
    clean = spark.read.schema(t.clean.schema).parquet(clean_path)
    report = quality_report(spark.read.parquet(funnel_path), clean)
    written = FT.publish_fact(spark, fact_root, FT.fact_rows(clean, loaded_at=True), retries=3)
    refresh_marts(spark, fact_root, os.path.join(out_dir, "marts"), retries=3)
    fact = FT.read_fact(spark, fact_root)
    register_staging(fact)
    for name, df in (("summary_by_type", summary_by_type(clean)), ("top_regions", top_regions(clean)),
                     ("rules", rule_results(clean, stg_transactions(fact), report))):
        df.write.mode("overwrite").parquet(os.path.join(out_dir, name))
    FT.append_audit(FT.audit_row(spark, report, run_id, written), audit_path)
    row = report.first().asDict()
    row["partitions_written"] = written
    return row
