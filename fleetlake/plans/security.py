"""Pattern scan of a table, with its report table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.patterns import DEFAULT_PATTERN
from fleetlake.operators.injection import check_arguments, find_violations, plan_scan
from fleetlake.schemas import VIOLATION_SCHEMA
from fleetlake.sources.listing import list_tree
from fleetlake.sources.storage import Storage
from fleetlake.sources.tables import read_for_scan

# Scanned columns and the name of the report table.
DEFAULT_COLUMNS = ["vin", "manufacturer", "model"]
REPORT_NAME = "sql_injection_report.parquet"


def write_violations(violations: DataFrame, output_dir: str, compression: str = "zstd") -> int:
    """Replace the report table, also by an empty one; returns the number of violations."""
    seen = Observation()
    (
        violations.select(*VIOLATION_SCHEMA.names)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", compression)
        .parquet(f"{output_dir}/{REPORT_NAME}")
    )
    return seen.get["rows"]


def run_scan(
    spark: SparkSession,
    data_path: str,
    *,
    columns: list[str] | None = None,
    patterns: list[str] | None = None,
    output_dir: str | None = None,
    schema: T.StructType | None = None,
) -> dict:
    """Scan all Parquet files below ``data_path``.

    ``violations`` is the lazy violation table, read back from the report when one is
    written. ``exit_code`` is 1 when there are violations.
    """
    started = time.time()
    columns = DEFAULT_COLUMNS if columns is None else columns
    patterns = [DEFAULT_PATTERN] if patterns is None else patterns
    check_arguments(columns, patterns)
    if not Storage(spark).exists(data_path):
        raise FileNotFoundError(f"Data directory not found: {data_path}")
    tree = list_tree(spark, data_path, hidden=True)
    table = read_for_scan(spark, data_path, schema, tree)
    notes: list[str] = []
    rows = 0
    violations = spark.createDataFrame([], VIOLATION_SCHEMA)
    if table is not None:
        usable = plan_scan(table, columns, patterns)
        notes = usable.warnings
        violations = find_violations(table, usable.columns, usable.patterns)
        # Counting rows needs the Parquet footers only.
        rows = table.count()
    # The violations are stored already, so this counts what one scan has found.
    found = violations.count() if output_dir is None else write_violations(violations, output_dir)
    if output_dir is not None:
        violations = spark.read.schema(VIOLATION_SCHEMA).parquet(f"{output_dir}/{REPORT_NAME}")
    return {
        "total_files_scanned": len(tree),
        "total_rows_scanned": rows,
        "violations_found": found,
        "violations": violations,
        "scan_duration_ms": 0.0 if table is None else round((time.time() - started) * 1000, 2),
        "warnings": notes,
        "exit_code": 1 if found else 0,
    }
