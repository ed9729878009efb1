from datetime import datetime
from pathlib import Path

import pytest

from fleetlake.operators import reports
from fleetlake.plans.gold import run_gold
from fleetlake.plans.reports import ReportRunner, run_sql
from fleetlake.sinks import write_table

SCHEMA = ("vin string, timestamp timestamp, velocity bigint, front_left_door_state string, "
          "wipers_state boolean")


def silver(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_top_ten(spark):
    at = datetime(2025, 1, 27, 10, 5)
    rows = [(f"v{i:02d}", at, None if i == 0 else i * 10, None, None) for i in range(12)]
    rows.append(("v11", at, 5, None, None))
    got = reports.fastest_vehicles_per_hour(silver(spark, rows)).collect()
    assert [r["vin"] for r in got] == [f"v{i:02d}" for i in range(11, 1, -1)]
    assert [r["rank"] for r in got] == list(range(1, 11))
    few = reports.fastest_vehicles_per_hour(silver(spark, rows[:3])).collect()
    assert few[-1]["vin"] == "v00" and few[-1]["max_velocity_per_vin"] is None


def test_day_of_month_merges_months_and_calendar_date_does_not(spark):
    rows = [("a", datetime(2025, 1, 5, 10), 1, None, None), ("a", datetime(2025, 2, 5, 10), 2, None, None)]
    assert reports.hourly_max_velocity(silver(spark, rows)).count() == 1
    assert reports.hourly_max_velocity(silver(spark, rows), by_calendar_date=True).count() == 2


def test_rank_filter_is_limited_before_the_shuffle(spark):
    plan = reports.fastest_vehicles_per_hour(silver(spark, []))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_last_state_both_forms(spark):
    t = [datetime(2025, 1, 1, h) for h in range(5)]
    rows = [
        ("a", t[0], 1, "OPEN", None), ("a", t[1], 1, None, True), ("a", t[2], 1, None, None),
        ("b", t[0], 1, None, None),
        ("c", t[3], 1, "CLOSED", True), ("c", t[3], 1, "OPEN", False), ("c", t[1], 1, "ZZ", True),
    ]
    expected = {("a", t[2], "OPEN", True), ("b", t[0], None, None), ("c", t[3], "OPEN", True)}
    assert {tuple(r) for r in reports.vin_last_state(silver(spark, rows)).collect()} == expected
    assert {tuple(r) for r in reports.vin_last_state_joined(silver(spark, rows)).collect()} == expected


def test_sql_report_and_text_timestamps(spark):
    df = silver(spark, [("a", datetime(2025, 1, 27, 3), 1, None, None)])
    spark.range(1).createOrReplaceTempView("report_table")
    out = run_sql(df, "SELECT vin, EXTRACT(HOUR FROM timestamp) AS h, CAST(timestamp AS STRING) AS Last_TimeStamp FROM report_table;")
    assert tuple(out.first()) == ("a", 3, datetime(2025, 1, 27, 3))
    assert spark.table("report_table").columns == ["id"]
    spark.catalog.dropTempView("report_table")


def test_a_table_of_the_views_name_is_not_shadowed_afterwards(spark):
    df = silver(spark, [("a", datetime(2025, 1, 27, 3), 1, None, None)])
    spark.range(3).write.mode("overwrite").saveAsTable("report_table")
    try:
        assert run_sql(df, "SELECT vin FROM report_table").count() == 1
        assert not spark.catalog.getTable("report_table").isTemporary
    finally:
        spark.sql("DROP TABLE report_table")


def test_a_wrong_queries_directory_deletes_nothing(spark, folder, tmp_path):
    df = silver(spark, [("a", datetime(2025, 1, 27, 3), 1, "OPEN", True)])
    write_table(df, f"{folder}/silver")
    old = f"{folder}/gold/vin_last_state_20200101_000000.parquet"
    df.write.parquet(old)
    with pytest.raises(FileNotFoundError):
        run_gold(spark, f"{folder}/silver", f"{folder}/gold", queries_dir=f"{folder}/nowhere")
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        run_gold(spark, f"{folder}/silver", f"{folder}/gold", queries_dir=str(tmp_path / "empty"))
    assert spark.read.parquet(old).count() == 1


def test_gold_removes_only_what_it_renewed(spark, folder, tmp_path):
    df = silver(spark, [("a", datetime(2025, 1, 27, 3), 1, "OPEN", True)])
    write_table(df, f"{folder}/silver")
    queries = tmp_path / "queries"
    queries.mkdir()
    (queries / "a.sql").write_text("SELECT count(*) AS n FROM report_table")
    (queries / "a_b.sql").write_text("SELECT nothing FROM report_table")
    for name in ("a", "a_b", "other"):
        df.write.parquet(f"{folder}/gold/{name}_20200101_000000.parquet")
    run = run_gold(spark, f"{folder}/silver", f"{folder}/gold", queries_dir=f"file:{queries}")
    assert (run["successful_reports"], run["failed_reports"]) == (["a"], ["a_b"])
    left = sorted(p.name for p in Path(folder, "gold").glob("*.parquet"))
    assert [n[: -len("_20200101_000000.parquet")] for n in left if "20200101" in n] == ["a_b", "other"] and len(left) == 3


def test_runner_and_gold(spark, folder, tmp_path):
    df = silver(spark, [("a", datetime(2025, 1, 27, 3), 1, "OPEN", True)])
    write_table(df, f"{folder}/silver")
    queries = tmp_path / "queries"
    queries.mkdir()
    (queries / "good.sql").write_text("SELECT count(*) AS n FROM report_table;")
    (queries / "bad.sql").write_text("SELECT nothing FROM report_table")
    runner = ReportRunner(spark, str(queries))
    assert runner.available() == ["bad", "good"]
    with pytest.raises(ValueError, match="Unknown reports"):
        runner.run_many(["good", "other"], f"{folder}/silver")
    with pytest.raises(FileNotFoundError):
        runner.build("other", df)
    result = runner.run_all(f"{folder}/silver")
    assert result["failed_reports"] == ["bad"] and result["status"] == "completed"
    assert result["results"]["good"]["output_rows"] == 1
    assert result["results"]["good"]["input_rows"] == 1

    stale = f"{folder}/gold/vin_last_state_20200101_000000.parquet"
    df.write.parquet(stale)
    gold = run_gold(spark, f"{folder}/silver", f"{folder}/gold")
    assert gold["successful_reports"] == ["fastest_vehicles_per_hour", "vin_last_state"]
    names = sorted(p.name for p in (tmp_path / folder.split("/")[-1] / "gold").glob("*.parquet"))
    assert len(names) == 2 and "vin_last_state_20200101_000000.parquet" not in names
    assert spark.read.parquet(f"{folder}/gold/{names[1]}").count() == 1
    missing = run_gold(spark, f"{folder}/none", f"{folder}/gold", report_names=["vin_last_state"])
    assert missing["failed_reports"] == ["vin_last_state"]
