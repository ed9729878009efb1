"""Reports to the Gold directory."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from fleetlake.plans.incremental import KeptReports
from fleetlake.plans.reports import ReportRunner
from fleetlake.sinks import write_unpartitioned
from fleetlake.sources.storage import Storage

# Fixed value: size cap of a Gold file.
GOLD_MAX_FILE_SIZE_MB = 1000.0


def run_gold(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    *,
    report_names: list[str] | None = None,
    queries_dir: str | None = None,
    state_dir: str | None = None,
) -> dict:
    """Run reports (all by default) and write ``<report>_<YYYYmmdd_HHMMSS>.parquet`` each.

    With ``state_dir`` partial results of the shipped reports are kept there, and only days of
    Silver that changed since the last run are read (incremental.py). Earlier outputs of a report are removed once its new one is complete. Those of reports that
    failed, or that this run did not ask for, stay.
    """
    if state_dir is not None and queries_dir is not None:
        raise ValueError("Partial results are kept for the shipped reports only")
    runner = ReportRunner(spark, queries_dir)
    storage = Storage(spark)
    names = runner.available() if report_names is None else report_names
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    earlier = storage.names(gold_dir, ".parquet")

    def write(name: str, result: DataFrame) -> int:
        target = f"{gold_dir}/{name}_{stamp}.parquet"
        return write_unpartitioned(
            result, target, max_file_size_mb=GOLD_MAX_FILE_SIZE_MB, keep_order=True
        ).rows

    if state_dir is None:
        result = runner.run_many(names, silver_dir, write)
    else:
        runner.check(names)
        kept = KeptReports(spark, state_dir)
        input_rows, days = kept.refresh(silver_dir, names)
        result = runner.run_each({name: kept.table(name) for name in names}, input_rows, write)
        result["days_read"] = days
    for old in earlier:
        named = re.fullmatch(r"(.*)_(\d{8}_\d{6})\.parquet", old)
        if named and named[1] in result["successful_reports"] and named[2] != stamp:
            storage.delete(f"{gold_dir}/{old}")
    return result
