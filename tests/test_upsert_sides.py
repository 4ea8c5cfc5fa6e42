"""The sides of the registered upserts come from stored stages that are derived once."""

import os

from conftest import SF_SMALL


def test_sides_are_derived_from_the_stored_rows_without_copies(spark, monkeypatch):
    from paylake import registry as R
    from paylake.session import stage_root
    plans, stored = [], R.materialize

    def materialize(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(R, "materialize", materialize)
    existing, incoming = R._upsert_sides(spark, SF_SMALL)
    assert len(plans) == 1 and "event_id" not in plans[0]  # not from the source tables
    left = [d for d in os.listdir(stage_root(spark).removeprefix("file:")) if d.startswith("classified")]
    assert left == []
    lazy = R.FX.upsert_pair(R._clean(spark, SF_SMALL))
    for side, expected in zip((existing, incoming), lazy):
        assert side.columns == expected.columns and side.count() > 0
        assert side.exceptAll(expected).isEmpty() and expected.exceptAll(side).isEmpty()


def test_events_that_repeat_their_numbers_count_once(spark, tmp_path):
    from paylake import registry as R
    sf = str(tmp_path)
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_id < 400")
    events.union(events.where("event_id % 3 = 0")).write.parquet(f"{sf}/events.parquet")
    for side, expected in zip(R._upsert_sides(spark, sf), R.FX.upsert_pair(R._clean(spark, sf))):
        assert side.exceptAll(expected).isEmpty() and expected.exceptAll(side).isEmpty()
        assert side.count() == side.select("transaction_id").distinct().count() > 0
