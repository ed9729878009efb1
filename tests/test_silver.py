from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.gear import gear_number
from fleetlake.functions.text import strip, strip_unicode
from fleetlake.operators.silver import check_silver, drop_null_vins, to_silver
from fleetlake.plans.silver import run_silver


def test_gear_numbers(spark):
    cases = {"P": 0, "R": 1, "N": 2, "D": 3, "L": 4, "p": 0, "d": 3, " P ": 0, "  D  ": 3, "X": -1,
             "INVALID": -1, "": -1, "PARK": 0, "reverse": 1, "NEUTRAL": 2, "DRIVE": 3, "LOW": 4,
             "-1": -1, "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5, "6": 6, "7": -1,
             "UNKNOWN": -1, "NULL": -1, None: None}
    df = spark.createDataFrame([(g,) for g in cases], "g string")
    got = df.select("g", gear_number(F.col("g")).alias("n")).collect()
    assert {r["g"]: r["n"] for r in got} == cases


def test_strip(spark):
    df = spark.createDataFrame([("Honda ",), (" Toyota",), ("Ford",), ("  BMW  ",), (" \t",), ("\x1cA",)], "m string")
    rows = df.select(strip_unicode(F.col("m")).alias("u"), strip(F.col("m")).alias("p")).collect()
    assert [r["p"] for r in rows] == ["Honda", "Toyota", "Ford", "BMW", "", "A"]
    assert [r["u"] for r in rows][-1] == "\x1cA"


SCHEMA = ("vin string, manufacturer string, gearPosition string, frontLeftDoorState string, "
          "wipersState boolean, driverSeatbeltState string, timestamp timestamp_ntz, extra int")
ROWS = [
    ("1HGBH41JXMN109186", "Honda ", "D", "closed", True, "buckled", datetime(2025, 1, 27, 10, 30), 1),
    ("1HGBH41JXMN109187", "Toyota", "P", "open", False, "unbuckled", datetime(2025, 1, 27, 10, 31), 2),
    (None, "Ford", "R", "closed", True, "buckled", datetime(2025, 1, 27, 10, 32), 3),
]


def test_to_silver(spark):
    silver = to_silver(spark.createDataFrame(ROWS, SCHEMA))
    assert silver.columns == ["vin", "manufacturer", "timestamp", "extra", "gear_position",
                              "front_left_door_state", "wipers_state", "driver_seatbelt_state"]
    rows = silver.collect()
    assert [(r["manufacturer"], r["gear_position"]) for r in rows] == [("Honda", 3), ("Toyota", 0)]
    assert rows[0]["timestamp"] == datetime(2025, 1, 27, 10, 30)


def test_null_filter_keeps_blank_and_is_pushed(spark, folder):
    spark.createDataFrame([("a",), (None,), ("",), (None,), ("b",)], "vin string").write.parquet(folder)
    kept = drop_null_vins(spark.read.parquet(folder))
    assert kept.count() == 3
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(vin)]" in plan


def test_run_silver(spark, folder):
    spark.createDataFrame(ROWS, SCHEMA).drop("extra").write.parquet(f"{folder}/bronze")
    stats = run_silver(spark, f"{folder}/bronze", f"{folder}/silver")
    assert (stats["input_rows"], stats["filtered_rows"], stats["output_rows"]) == (3, 1, 2)
    back = spark.read.parquet(f"{folder}/silver")
    assert back.select("date", "hour").distinct().count() == 1
    assert run_silver(spark, f"{folder}/none", f"{folder}/out")["status"] == "completed"
    with pytest.raises(ValueError):
        run_silver(spark, f"{folder}/bronze", f"{folder}/bronze")


def test_constraints(spark):
    at = datetime(2025, 1, 27)
    rows = [("v", " Honda ", g, at) for g in (-1, 0, 6, 7)] + [(" ", "  ", None, at), ("a ", None, 1, None)]
    df = spark.createDataFrame(rows, "vin string, manufacturer string, gear_position bigint, timestamp timestamp")
    got = check_silver(df).collect()
    assert [[e["field"] for e in r["errors"]] for r in got] == [[], [], [], ["gear_position"], ["vin"], ["timestamp"]]
    assert "Gear position must be -1 to 6" in got[3]["errors"][0]["message"]
    assert (got[0]["vin"], got[0]["manufacturer"], got[4]["manufacturer"]) == ("V", "Honda", None)
    with pytest.raises(ValueError):
        check_silver(df.withColumn("other", F.lit(1)))
    with pytest.raises(ValueError):
        check_silver(df.drop("gear_position"))
