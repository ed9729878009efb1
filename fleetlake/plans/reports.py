"""Named reports over the Silver table, which SQL text sees as ``report_table``."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.operators.reports import fastest_vehicles_per_hour, vin_last_state
from fleetlake.sources.storage import Storage
from fleetlake.sources.tables import read_silver

REPORT_TABLE = "report_table"

Report = Callable[[DataFrame], DataFrame]

# The shipped reports; a directory of ``<name>.sql`` files replaces them.
SHIPPED_REPORTS: dict[str, Report] = {
    "fastest_vehicles_per_hour": fastest_vehicles_per_hour,
    "vin_last_state": vin_last_state,
}


# Threads that share a session bind the view one after another.
_VIEW = RLock()


@contextmanager
def _report_table(silver: DataFrame):
    """``report_table`` for the time of one analysis.

    A temporary view of that name is put back after it; a table of that name is only hidden
    meanwhile.
    """
    spark = silver.sparkSession
    with _VIEW:
        exists = spark.catalog.tableExists(REPORT_TABLE)
        before = spark.table(REPORT_TABLE) if exists and spark.catalog.getTable(REPORT_TABLE).isTemporary else None
        silver.createOrReplaceTempView(REPORT_TABLE)
        try:
            yield
        finally:
            spark.catalog.dropTempView(REPORT_TABLE)
            if before is not None:
                before.createOrReplaceTempView(REPORT_TABLE)


def text_timestamps_to_utc(df: DataFrame) -> DataFrame:
    """Text columns with "timestamp" in their name become UTC timestamps."""
    return df.select(
        *[
            F.to_timestamp(F.col(f"`{f.name}`")).alias(f.name)
            if f.dataType == T.StringType() and "timestamp" in f.name.lower()
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def run_sql(silver: DataFrame, text: str) -> DataFrame:
    """Any query text over ``report_table``; the view is bound when the text is analysed."""
    with _report_table(silver):
        return text_timestamps_to_utc(silver.sparkSession.sql(text.strip().rstrip(";")))


class ReportRunner:
    """Runs the shipped reports, or the ``<name>.sql`` files of a directory on any storage."""

    def __init__(self, spark: SparkSession, queries_dir: str | None = None):
        self.spark = spark
        self.queries_dir = queries_dir

    def available(self) -> list[str]:
        if self.queries_dir is None:
            return list(SHIPPED_REPORTS)
        storage = Storage(self.spark)
        if not storage.exists(self.queries_dir):
            raise FileNotFoundError(f"Queries directory not found: {self.queries_dir}")
        names = [n.removesuffix(".sql") for n in storage.names(self.queries_dir, ".sql")]
        if not names:
            raise FileNotFoundError(f"No .sql files in {self.queries_dir}")
        return names

    def build(self, name: str, silver: DataFrame) -> tuple[str | None, DataFrame]:
        """The SQL file, if any, and the still lazy result of one report."""
        if self.queries_dir is None:
            if name not in SHIPPED_REPORTS:
                raise FileNotFoundError(f"SQL file not found: {name}.sql")
            return None, SHIPPED_REPORTS[name](silver)
        sql_file = f"{self.queries_dir.rstrip('/')}/{name}.sql"
        if not Storage(self.spark).exists(sql_file):
            raise FileNotFoundError(f"SQL file not found: {sql_file}")
        text = self.spark.read.text(sql_file, wholetext=True).first()
        return sql_file, run_sql(silver, text["value"] if text else "")

    def run(
        self,
        name: str,
        silver: DataFrame,
        input_rows: int | None = None,
        write: Callable[[str, DataFrame], int] | None = None,
    ) -> dict:
        """Run one report once: through ``write`` when given, otherwise by counting its rows."""
        sql_file, result = self.build(name, silver)
        return {
            "status": "completed",
            "report_name": name,
            "sql_file": sql_file,
            "input_rows": silver.count() if input_rows is None else input_rows,
            "output_rows": result.count() if write is None else write(name, result),
            "result_data": result,
        }

    def run_many(
        self,
        names: list[str],
        silver_dir: str,
        write: Callable[[str, DataFrame], int] | None = None,
    ) -> dict:
        """Run reports over one read of Silver; a failing report is recorded, the rest go on."""
        self.check(names)
        try:
            silver = read_silver(self.spark, silver_dir)
            input_rows, unreadable = silver.count(), None
        except Exception as error:
            silver, input_rows, unreadable = None, None, error
        return self.run_each(dict.fromkeys(names, silver), input_rows, write, unreadable)

    def check(self, names: list[str]) -> None:
        available = self.available()
        unknown = [n for n in names if n not in available]
        if unknown:
            raise ValueError(
                f"Unknown reports: {unknown}. Available reports: {', '.join(available)}"
            )

    def run_each(
        self,
        tables: dict[str, DataFrame | None],
        input_rows: int | None,
        write: Callable[[str, DataFrame], int] | None = None,
        unreadable: Exception | None = None,
    ) -> dict:
        """Run each report over its table; a failing report is recorded, the rest go on."""
        started = time.time()
        results: dict[str, dict] = {}
        for name, table in tables.items():
            try:
                if unreadable is not None:
                    raise unreadable
                results[name] = self.run(name, table, input_rows, write)
            except Exception as error:
                results[name] = {"status": "failed", "error": str(error), "report_name": name}
        return {
            "status": "completed",
            "total_reports": len(tables),
            "successful_reports": [n for n in tables if results[n]["status"] == "completed"],
            "failed_reports": [n for n in tables if results[n]["status"] == "failed"],
            "total_duration_ms": round((time.time() - started) * 1000, 2),
            "results": results,
        }

    def run_all(self, silver_dir: str) -> dict:
        return self.run_many(self.available(), silver_dir)
