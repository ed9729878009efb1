"""Reports from kept partial results, so that a run reads only the days of Silver that changed.

For each report a reduction of Silver is kept, with one row where the report cannot tell rows apart: per
vehicle and hour the greatest velocity, per vehicle and state the last time. Reductions have
Silver's column names, and a report over the reductions of all days is the report over all of Silver, as both
only take maxima; so the reports run over them unchanged. They are kept by day. A day is reduced anew
when its files are others than those it was reduced from: writes never reuse a file's name. The list
of files is written last, so a run that dies leaves days that the next run reduces again.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.sources.listing import Tree, list_tree
from fleetlake.sources.storage import Storage
from fleetlake.sources.tables import read_tree

_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _fastest_of_hours(silver: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "timestamp").alias("timestamp")
    return silver.groupBy("date", "vin", hour).agg(F.max("velocity").alias("velocity"))


def _last_of_states(silver: DataFrame) -> DataFrame:
    return silver.groupBy("date", "vin", "front_left_door_state", "wipers_state").agg(
        F.max("timestamp").alias("timestamp")
    )


# By the report that can be made from it.
REDUCTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fastest_vehicles_per_hour": _fastest_of_hours,
    "vin_last_state": _last_of_states,
}


def files_of_days(tree: Tree) -> dict[str, str]:
    """Day → digest of the names of its files. Silver has to be partitioned by ``date`` first."""
    names = defaultdict(list)
    for folder, file in tree.relative():
        key, equals, day = folder.partition("/")[0].partition("=")
        if key != "date" or not equals:
            raise ValueError(f"Reports can be kept for a Silver table partitioned by date only, not for {tree.path}")
        names[day].append(f"{folder}/{file}")
    return {day: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for day, files in names.items()}


class KeptReports:
    """The reductions below ``path``, one table per report."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.storage = spark, path.rstrip("/"), Storage(spark)
        self.list = f"{self.path}/_days.json"

    def _known(self) -> dict[str, dict]:
        return json.loads(self.storage.read_text(self.list)) if self.storage.exists(self.list) else {}

    def refresh(self, silver_dir: str, names: list[str]) -> tuple[int, list[str]]:
        """Reduce the days that changed; returns the rows of all of Silver, and those days."""
        tree = list_tree(self.spark, silver_dir)
        if not tree.files:
            raise FileNotFoundError(f"No Silver data found in {silver_dir}")
        now, known = files_of_days(tree), self._known()

        def current(day: str) -> bool:
            return day in known and known[day]["files"] == now.get(day) and set(names) <= set(known[day]["reports"])

        changed = sorted(day for day in now if not current(day))
        gone = sorted(day for day in known if day not in now)
        kept = {day: known[day] for day in now if day not in changed}
        if changed:
            silver = read_tree(self.spark, silver_dir, tree=tree)
            date = F.coalesce(F.col("date").cast("string"), F.lit(_NO_DATE))
            part = silver.where(date.isin(changed)).withColumn("date", date)
            rows = {r["date"]: r["count"] for r in part.groupBy("date").count().collect()}
            for name in names:
                for day in changed:
                    self.storage.delete(f"{self.path}/{name}/date={day}")
                (
                    REDUCTIONS[name](part).hint("rebalance", "date")
                    .write.mode("append").partitionBy("date").parquet(f"{self.path}/{name}")
                )
            kept |= {day: {"files": now[day], "rows": rows.get(day, 0), "reports": names} for day in changed}
        for name in REDUCTIONS:
            for day in gone:
                self.storage.delete(f"{self.path}/{name}/date={day}")
        if changed or gone:
            self.storage.write_text(self.list, json.dumps(kept))
        return sum(day["rows"] for day in kept.values()), changed

    def table(self, name: str) -> DataFrame:
        """The rows from which a report can be made."""
        return self.spark.read.parquet(f"{self.path}/{name}").drop("date")
