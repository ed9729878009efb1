"""The Bronze table to the Silver table."""

from __future__ import annotations

import time

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.operators.silver import to_silver
from fleetlake.schemas import BRONZE_TABLE_SCHEMA
from fleetlake.sinks import DATE_HOUR, write_table
from fleetlake.sources.listing import list_tree
from fleetlake.sources.storage import Storage
from fleetlake.sources.tables import read_bronze


def run_silver(
    spark: SparkSession,
    bronze_dir: str,
    output_dir: str,
    *,
    schema: T.StructType | None = BRONZE_TABLE_SCHEMA,
    clustered: bool = True,
    **write_options,
) -> dict:
    """One map-only job: Bronze files hold one (date, hour) each, so no row has to move.

    Pass ``clustered=False`` for a Bronze table laid out in another way. Missing or empty
    Bronze is a completed run with zeros.
    """
    started = time.time()
    storage = Storage(spark)
    source, target = (f"{storage.qualified(p)}/" for p in (bronze_dir, output_dir))
    if source.startswith(target) or target.startswith(source):
        raise ValueError("Silver cannot be written into the table it is read from, or around it")
    result = {
        "status": "completed",
        "input_rows": 0,
        "output_rows": 0,
        "filtered_rows": 0,
        "duration_ms": 0,
    }
    tree = list_tree(spark, bronze_dir)
    if not tree.files:
        return result
    counted = Observation()
    bronze = read_bronze(spark, bronze_dir, schema, tree)
    bronze = bronze.drop(*[c for c in DATE_HOUR if c in bronze.columns]).observe(
        counted,
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col("vin").isNull()).alias("filtered_rows"),
    )
    stats = write_table(to_silver(bronze), output_dir, clustered=clustered, **write_options)
    return {
        **result,
        **counted.get,
        "output_rows": stats.rows,
        "files_written": stats.files_written,
        "partitions": stats.partitions,
        "duration_ms": round((time.time() - started) * 1000, 2),
    }
