"""Publish the staging view and the marts.

Staging is a view (a lazy frame registered by name, recomputed by every
reader, like a database view); the marts are materialised tables written
once per run, so dashboards read small precomputed results.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from paylake.plans import marts as M
from paylake.plans.staging import stg_transactions

MARTS = {
    "mart_daily_revenue": M.mart_daily,
    "mart_operator_performance": M.mart_operator,
    "mart_region_summary": M.mart_region,
    "mart_high_value_transactions": M.mart_high_value,
}


def register_staging(fact: DataFrame, name: str = "stg_transactions") -> DataFrame:
    stg = stg_transactions(fact, with_loaded_at="loaded_at" in fact.columns)
    stg.createOrReplaceTempView(name)
    return stg


def publish_marts(fact: DataFrame, out_dir: str) -> dict[str, str]:
    """Write every mart under ``out_dir/<mart>``; returns name -> path.

    The staging frame feeds four aggregations; each mart is a separate
    write, and each reads only the staging columns it needs.
    """
    stg = register_staging(fact)
    paths = {}
    for name, build in MARTS.items():
        path = os.path.join(out_dir, name)
        build(stg).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
