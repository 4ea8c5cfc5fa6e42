"""Data-quality rules as operators: each returns what fails (empty = pass),
so a rule runs on a table of any size and its output is the evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.schemas import ACCEPTED_OPERATORS, ACCEPTED_STATUSES, TYPE_LABELS, UNKNOWN_LABEL


def duplicate_keys(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys that occur more than once, with their count (map-side combined)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_name, null_rows)`` for each checked column, one scan."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_rows)")


def _allowed(spark: SparkSession, values: list[str], name: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def not_accepted(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Distinct non-null values of ``col`` outside ``values`` with row counts.

    The allowed set is a handful of literals: a broadcast anti join.
    """
    allowed = _allowed(df.sparkSession, values, col)
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
            .join(F.broadcast(allowed), col, "left_anti"))


def bad_operators(stg: DataFrame) -> DataFrame:
    return not_accepted(stg, "operator", ACCEPTED_OPERATORS)


def bad_statuses(stg: DataFrame) -> DataFrame:
    return not_accepted(stg, "transaction_status", ACCEPTED_STATUSES)


def bad_type_labels(clean: DataFrame) -> DataFrame:
    """Labels outside the dictionary values plus ``Unknown``."""
    return not_accepted(clean, "transaction_type_label", list(TYPE_LABELS.values()) + [UNKNOWN_LABEL])


def non_positive_amounts(clean: DataFrame, col: str = "amount") -> DataFrame:
    return clean.where(F.col(col) <= 0)


def total_debit_mismatch(clean: DataFrame) -> DataFrame:
    """Rows where ``total_debit <> amount + fee`` (null-safe)."""
    expect = (F.col("amount") + F.col("fee")).cast("decimal(21,2)")
    return clean.where(~F.col("total_debit").cast("decimal(21,2)").eqNullSafe(expect))


def report_bounds(report: DataFrame) -> DataFrame:
    """Violations of the report invariants (empty when all hold):
    raw = clean + dropped; clean <= raw; 0 <= success rate <= 100."""
    checks = [
        ("counts_add_up", F.col("raw_count") == F.col("clean_count") + F.col("records_dropped")),
        ("clean_not_above_raw", F.col("clean_count") <= F.col("raw_count")),
        ("rate_in_range", F.col("success_rate_pct").isNull()
         | F.col("success_rate_pct").between(0, 100)),
    ]
    rows = report.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.coalesce(c, F.lit(False)).alias("ok")) for n, c in checks
    ])).alias("c"))
    return rows.where(~F.col("c.ok")).select(F.col("c.rule").alias("rule"))


def required_columns(df: DataFrame, required: list[str], booleans: list[str] = ()) -> list[str]:
    """Schema check (driver-side metadata only): missing columns and
    non-boolean flag columns."""
    names = set(df.columns)
    problems = [f"missing:{c}" for c in required if c not in names]
    types = dict(df.dtypes)
    problems += [f"not_boolean:{c}" for c in booleans if c in types and types[c] != "boolean"]
    return problems
