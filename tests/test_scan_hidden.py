"""The scan reads files that Spark's listing passes over."""

import pytest

from fleetlake.plans.security import run_scan


@pytest.mark.parametrize("plain", [True, False])
def test_hidden_files_are_scanned(spark, folder, plain):
    bad = spark.createDataFrame([("x'; DROP TABLE users; --",)], "vin string")
    clean = spark.createDataFrame([("abc",)], "vin string")
    for at in ("_old", ".keep/inner", "_old/_deeper", "date=1/_tmp"):
        bad.coalesce(1).write.parquet(f"{folder}/{at}")
    if plain:
        clean.coalesce(1).write.parquet(f"{folder}/date=1/hour=2")
    result = run_scan(spark, folder, columns=["vin"], patterns=["DROP TABLE"])
    assert (result["total_files_scanned"], result["total_rows_scanned"]) == (4 + plain, 4 + plain)
    assert result["violations_found"] == 4
