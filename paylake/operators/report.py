"""Batch quality report and the two run-summary aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.numeric import half_up_ratio
from paylake.operators.clean import ISSUE_KEYS


def quality_report(funnel: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: raw/clean counts, flag counts, success rate and the issue map.

    ``funnel`` is :func:`reject_funnel` (reason -> rows, ``clean`` included);
    ``clean`` is the flagged clean frame. The success rate counts a null
    status in the denominator (as the batch pipeline does).
    """
    f = funnel.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("raw_count"),
        *[F.coalesce(F.sum(F.when(F.col("reject_reason") == k, F.col("rows"))), F.lit(0)).cast("long").alias(k)
          for k in ISSUE_KEYS],
    )
    c = clean.agg(
        F.count(F.lit(1)).alias("clean_count"),
        F.count_if(F.col("is_high_value")).alias("high_value_flagged"),
        F.count_if(F.col("is_rapid_succession")).alias("rapid_succession_flagged"),
        F.count_if(F.col("status") == "SUCCESS").alias("_succ"),
    )
    # the funnel totals join the clean-row totals as one struct-valued scalar
    # subquery (both sides are single-row aggregates; no join)
    fs = f.select(F.struct(*f.columns).alias("f")).scalar()
    out = c.select("*", fs.alias("_f")).select("*", "_f.*").drop("_f")
    issues = F.create_map(*[x for k in ISSUE_KEYS for x in (F.lit(k), F.col(k))])
    return out.select(
        "raw_count", "clean_count",
        (F.col("raw_count") - F.col("clean_count")).alias("records_dropped"),
        "high_value_flagged", "rapid_succession_flagged",
        half_up_ratio(F.col("_succ"), F.col("clean_count"), 2, 100).alias("success_rate_pct"),
        *ISSUE_KEYS,
        issues.alias("issues"),
    )


def summary_by_type(clean: DataFrame) -> DataFrame:
    """Count and total amount per type label, largest total first."""
    return (clean.groupBy("transaction_type_label")
            .agg(F.count("amount").alias("txn_count"), F.sum("amount").alias("_total"))
            .select("transaction_type_label", "txn_count",
                    F.col("_total").cast("double").alias("total_ghs"))
            .orderBy(F.desc("total_ghs"), "transaction_type_label"))


def top_regions(clean: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` regions with the largest total amount (null region excluded)."""
    return (clean.where(F.col("region").isNotNull())
            .groupBy("region").agg(F.sum("amount").alias("_total"))
            .select("region", F.col("_total").cast("double").alias("total_ghs"))
            .orderBy(F.desc("total_ghs"), "region").limit(n))
