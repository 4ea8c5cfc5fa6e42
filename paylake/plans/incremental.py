"""Marts that follow the fact table by its touched dates.

For every date the mart folder keeps mergeable partial results: additive sums by
(date, operator, region, hour); the different subscribers of each operator and region as
bitmaps over dense numbers (exact) and as HyperLogLog sketches; and the flagged transactions.
A refresh recomputes them for the dates whose files changed since the last
one, merges all of them into the marts and commits the result as a version: readers
see the marts of one refresh, never a mixture and never none.

What a refresh reads of the fact table is the touched dates; what it merges has the
size of the key domains (a bitmap: 4 KB for each 32,768 subscribers and key that occur).
Dense numbers come from a dictionary that only grows; each refresh adds the
subscribers it sees first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.operators import fact as FT
from paylake.operators import versions as V
from paylake.plans import marts as M
from paylake.plans.staging import stg_transactions
from paylake.session import materialize_at, stage_scope

DATE = "transaction_date"
HIGH_VALUE = "mart_high_value_transactions"
#: What is counted without repetition: dimension of the mart, its column, the subscriber column.
SUBSCRIBERS = (("operator_senders", "operator", "sender_msisdn"), ("operator_receivers", "operator", "receiver_msisdn"),
               ("region_senders", "region", "sender_msisdn"))
#: log2 of a sketch's registers: a standard error of about 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_BITS = 12


def subscribers(stg: DataFrame) -> DataFrame:
    """``(transaction_date, dimension, member, value)`` without repetition."""
    pick = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(m).alias("member"), F.col(v).alias("value"))
                               for d, m, v in SUBSCRIBERS]))
    return stg.select(DATE, pick.alias("s")).select(DATE, "s.*").where("value IS NOT NULL").distinct()


def numbered(values: DataFrame, first: int) -> DataFrame:
    """``(value, id)``: the rows of ``values`` numbered from ``first`` without gaps. Each task numbers
    its rows; the sizes of the tasks' parts (one row per task) say where they start."""
    parts, _ = materialize_at(values.select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "numbered")
    order = Window.orderBy("part")
    starts = (parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("zero"))
              .select("part", "zero", (F.sum("n").over(order) - F.col("n") + first).alias("start")))
    return parts.join(F.broadcast(starts), "part").select("value", (F.col("start") + F.col("at") - F.col("zero")).alias("id"))


def dictionary(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    schema = "value string, id long"
    return spark.read.schema(schema).parquet(*[f"{root}/dictionary/{r}" for r in runs]) if runs else spark.createDataFrame([], schema)


def bitmaps(found: DataFrame, ids: DataFrame) -> DataFrame:
    """One bitmap for each (date, dimension, member) and 32,768 numbers."""
    return (found.join(ids, "value")
            .groupBy(DATE, "dimension", "member", F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))


def sketches(found: DataFrame) -> DataFrame:
    return found.groupBy(DATE, "dimension", "member").agg(F.hll_sketch_agg("value", SKETCH_BITS).alias("sketch"))


def distinct_counts(bits: DataFrame) -> DataFrame:
    """``(dimension, member, n)`` over all dates, exact."""
    merged = bits.groupBy("dimension", "member", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("dimension", "member").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def sketch_counts(stored: DataFrame) -> DataFrame:
    """``(dimension, member, estimate)`` over all dates."""
    return stored.groupBy("dimension", "member").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


class MartFolder:
    """The last version of a mart folder, for reading."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.state = V.last_version(spark, self.root)

    def partials(self, kind: str, schema) -> DataFrame:
        """The partial results of every date, from the run that wrote the date last."""
        runs = self.state.get("runs", {})
        if not runs:
            return self.spark.createDataFrame([], schema).drop("run")
        current = self.spark.createDataFrame(sorted(runs.items()), f"{DATE} string, run string")
        current = current.withColumn(DATE, F.col(DATE).cast("date"))
        base = f"{self.root}/{kind}"
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/run={r}" for r in sorted(set(runs.values()))])
        return rows.join(F.broadcast(current), [DATE, "run"], "left_semi").drop("run")  # a row for each calendar day

    def mart(self, name: str) -> DataFrame:
        """A mart of the last refresh, in its order."""
        if self.version is None:
            raise LookupError(f"{self.root}: no refresh yet")
        if name == HIGH_VALUE:
            return M.ordered_high_value(self.partials("flagged", self.state["schemas"]["flagged"]))
        return self.spark.read.parquet(f"{self.root}/marts/{self.state['run']}/{name}")

    def sums(self) -> DataFrame:
        return self.partials("sums", self.state["schemas"]["sums"])

    def subscriber_counts(self) -> DataFrame:
        """Exact and estimated numbers of different subscribers: ``(dimension, member, n, estimate)``."""
        exact = distinct_counts(self.partials("bits", self.state["schemas"]["bits"]))
        about = sketch_counts(self.partials("sketches", self.state["schemas"]["sketches"]))
        same = exact["dimension"].eqNullSafe(about["dimension"]) & exact["member"].eqNullSafe(about["member"])
        return exact.join(about, same).select(exact["dimension"], exact["member"], "n", "estimate")


def refresh_marts(spark: SparkSession, fact_root: str, root: str, retries: int = 0) -> int:
    """Bring the marts at ``root`` up to the last version of the fact table; returns the number
    of dates recomputed. A conflict with another refresh is raised after ``retries`` more attempts."""
    for left in range(retries, -1, -1):
        try:
            return _refresh(spark, fact_root, root.rstrip("/"))
        except V.CommitConflict:
            if not left:
                raise


def _refresh(spark: SparkSession, fact_root: str, root: str) -> int:
    held = {d: f for d, f in V.last_version(spark, fact_root)[1].get("dates", {}).items() if d != FT.NO_DATE}
    old = MartFolder(spark, root)
    before = old.state.get("fact", {})
    touched = sorted(d for d in held if before.get(d) != held[d])
    if old.version is not None and not touched:
        return 0
    run, runs = uuid.uuid4().hex, list(old.state.get("dictionary", []))
    stg = stg_transactions(FT.read_dates(spark, fact_root, {d: held[d] for d in touched}))
    written = []

    def write(df: DataFrame, path: str, by_date: bool = True) -> None:
        written.append(path)
        if by_date:  # a date is read and replaced as one
            df = df.hint("rebalance", DATE)
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(DATE) if by_date else writer).parquet(path)

    try:
        with stage_scope(spark):
            found, _ = materialize_at(subscribers(stg), "subscribers")
            known = dictionary(spark, root, runs)
            new = found.select("value").distinct().join(known, "value", "left_anti")
            write(numbered(new, old.state.get("subscribers", 0) + 1), f"{root}/dictionary/{run}", by_date=False)
            runs.append(run)
            known = dictionary(spark, root, runs)
            parts = {"sums": M.partial_sums(stg), "bits": bitmaps(found, known), "sketches": sketches(found), "flagged": M.flagged(stg)}
            for kind, df in parts.items():
                write(df, f"{root}/{kind}/run={run}")
        schemas = {kind: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", run string" for kind, df in parts.items()}
        now = MartFolder(spark, root)
        now.state = {"fact": held, "runs": old.state.get("runs", {}) | dict.fromkeys(touched, run), "dictionary": runs, "run": run,
                     "subscribers": known.count(), "schemas": schemas}
        sums, counts = now.sums(), distinct_counts(now.partials("bits", schemas["bits"]))
        for name, df in (("mart_daily_revenue", M.daily_rows(M.merge(sums, DATE, "is_weekend"))),
                         ("mart_operator_performance", M.operator_rows(_with_counts(
                             M.merge(sums, "operator"), counts, "operator", unique_senders="operator_senders", unique_receivers="operator_receivers"))),
                         ("mart_region_summary", M.region_rows(_with_counts(
                             M.merge_regions(sums), counts, "region", unique_customers="region_senders")))):
            write(df, f"{root}/marts/{run}/{name}", by_date=False)
        V.commit(spark, root, 0 if old.version is None else old.version + 1, now.state)
    except BaseException:
        for path in written:
            V.delete(spark, path)
        raise
    return len(touched)


def _with_counts(agg: DataFrame, counts: DataFrame, by: str, **columns: str) -> DataFrame:
    """``agg`` with the numbers of different subscribers (0 for none); both sides have a row for each member."""
    pick = [F.coalesce(F.max(F.when(F.col("dimension") == d, F.col("n"))), F.lit(0)).alias(c) for c, d in columns.items()]
    wide = counts.where(F.col("dimension").isin(list(columns.values()))).groupBy(F.col("member").alias("_member")).agg(*pick)
    return (agg.join(wide, F.col(by).eqNullSafe(F.col("_member")), "left").drop("_member")
            .fillna(0, list(columns)))
