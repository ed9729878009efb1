"""The whole pipeline: landing files, Bronze, Silver, Gold, scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlake.plans.bronze import run_bronze
from fleetlake.plans.gold import run_gold
from fleetlake.plans.security import run_scan
from fleetlake.plans.silver import run_silver
from fleetlake.schemas import BRONZE_TABLE_SCHEMA

_METRICS_SCHEMA = "step string, event string, metric string, value double, level string"


def step_metrics(spark: SparkSession, step: str, result: dict, event: str = "completed") -> DataFrame:
    """The numbers of one step's result as rows; a handful per step."""
    numbers = {
        k: float(v)
        for k, v in result.items()
        if isinstance(v, (int, float)) and not isinstance(v, bool)
    }
    level = "WARNING" if result.get("failed_reports") or result.get("warnings") else "INFO"
    return spark.createDataFrame(
        [(step, event, k, v, level) for k, v in numbers.items()], _METRICS_SCHEMA
    )


def run_pipeline(
    spark: SparkSession,
    landing_path: str,
    base_dir: str,
    *,
    layout: str = "lines",
    amount: int | None = None,
    report_names: list[str] | None = None,
) -> dict:
    """Run the steps in order; a step that raises stops the run.

    ``exit_code`` is the scan's: 1 when violations were found.
    """
    bronze_dir, silver_dir = f"{base_dir}/bronze", f"{base_dir}/silver"
    bronze = run_bronze(spark, landing_path, bronze_dir, layout=layout, amount=amount)
    silver = run_silver(spark, bronze_dir, silver_dir)
    gold = run_gold(spark, silver_dir, f"{base_dir}/gold", report_names=report_names)
    # The Bronze schema is known, so no footer merging is needed.
    scan = run_scan(
        spark,
        bronze_dir,
        output_dir=f"{base_dir}/sql_injection_report",
        schema=BRONZE_TABLE_SCHEMA,
    )
    steps = {"bronze": bronze, "silver": silver, "gold": gold, "scan": scan}
    metrics = None
    for name, result in steps.items():
        rows = step_metrics(spark, name, result)
        metrics = rows if metrics is None else metrics.unionByName(rows)
    return {**steps, "run_metrics": metrics, "exit_code": scan["exit_code"]}
