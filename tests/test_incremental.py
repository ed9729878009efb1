"""Reports from kept partial results against reports over all of Silver."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.reports import fastest_vehicles_per_hour, vin_last_state
from fleetlake.plans import incremental
from fleetlake.plans.gold import run_gold
from fleetlake.plans.incremental import KeptReports, files_of_days
from fleetlake.sinks import write_table
from fleetlake.sources.listing import list_tree

SCHEMA = "vin string, velocity bigint, front_left_door_state string, wipers_state boolean, timestamp timestamp"


def rows(rng, days, n):
    out = []
    for _ in range(n):
        at = datetime(2025, 1, 27) + timedelta(days=rng.choice(days), minutes=rng.randrange(24 * 60))
        out.append((f"v{rng.randrange(12)}", rng.choice([None, rng.randrange(200)]), rng.choice([None, "OPEN", "CLOSED"]),
                    rng.choice([None, True, False]), rng.choice([at, at, at, None]) if n > 60 else at))
    return out


def same(spark, folder, result):
    silver = spark.read.parquet(f"{folder}/silver")
    for name, report in (("fastest_vehicles_per_hour", fastest_vehicles_per_hour), ("vin_last_state", vin_last_state)):
        got = result["results"][name]["result_data"]
        assert sorted(map(repr, got.collect())) == sorted(map(repr, report(silver).collect()))
        assert result["results"][name]["input_rows"] == silver.count()


def test_late_batches(spark, folder):
    rng = random.Random(3)
    kept = {}
    for days in ([0, 1, 2, 5], [1], [7, 5], [2, 8], []):
        for day in days:
            kept[day] = kept.get(day, []) + rows(rng, [day], 40)
        batch = [r for day in days for r in kept[day]]
        if batch:
            write_table(spark.createDataFrame(batch, SCHEMA), f"{folder}/silver", partition_columns=["date"])
        result = run_gold(spark, f"{folder}/silver", f"{folder}/gold", state_dir=f"{folder}/kept")
        assert result["days_read"] == sorted(str(datetime(2025, 1, 27).date() + timedelta(days=d)) for d in days)
        same(spark, folder, result)


def test_hours_without_time_and_removed_days(spark, folder, tmp_path):
    write_table(spark.createDataFrame(rows(random.Random(1), range(3), 300), SCHEMA), f"{folder}/silver")
    first = run_gold(spark, f"{folder}/silver", f"{folder}/gold", state_dir=f"{folder}/kept")
    assert len(first["days_read"]) == 4 and "__HIVE_DEFAULT_PARTITION__" in first["days_read"]
    same(spark, folder, first)
    from fleetlake.sources.storage import Storage

    Storage(spark).delete(f"{folder}/silver/date=2025-01-28")
    again = run_gold(spark, f"{folder}/silver", f"{folder}/gold", state_dir=f"{folder}/kept")
    assert again["days_read"] == []
    same(spark, folder, again)


def test_a_run_that_dies_is_made_good(spark, folder, monkeypatch):
    data = rows(random.Random(2), range(3), 50)
    write_table(spark.createDataFrame(data, SCHEMA), f"{folder}/silver", partition_columns=["date"])
    with monkeypatch.context() as patch:
        patch.setattr(incremental.Storage, "write_text", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            run_gold(spark, f"{folder}/silver", f"{folder}/gold", state_dir=f"{folder}/kept")
    result = run_gold(spark, f"{folder}/silver", f"{folder}/gold", state_dir=f"{folder}/kept")
    assert len(result["days_read"]) == 3
    same(spark, folder, result)


def test_only_changed_days_are_scanned(spark, folder):
    write_table(spark.createDataFrame(rows(random.Random(4), range(4), 50), SCHEMA), f"{folder}/silver", partition_columns=["date"])
    days = files_of_days(list_tree(spark, f"{folder}/silver"))
    assert len(days) == 4
    part = spark.read.parquet(f"{folder}/silver").where(F.coalesce(F.col("date").cast("string"), F.lit("x")).isin([min(days)]))
    assert len(part.select("_metadata.file_path").distinct().collect()) == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [(coalesce(" in plan and "DataFilters: []" in plan


def test_reports_that_cannot_be_kept(spark, folder):
    spark.createDataFrame(rows(random.Random(4), [0], 5), SCHEMA).write.parquet(f"{folder}/silver")
    with pytest.raises(ValueError, match="partitioned by date"):
        run_gold(spark, f"{folder}/silver", f"{folder}/gold", state_dir=f"{folder}/kept")
    with pytest.raises(ValueError, match="shipped reports"):
        run_gold(spark, f"{folder}/silver", f"{folder}/gold", state_dir=f"{folder}/kept", queries_dir=folder)
    with pytest.raises(FileNotFoundError):
        KeptReports(spark, f"{folder}/kept").refresh(f"{folder}/none", ["vin_last_state"])
