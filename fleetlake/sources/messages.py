"""Landing files of raw vehicle messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.text import is_one_value
from fleetlake.sources.json_lists import read_large_lists


# A JSON list of more bytes is read by many tasks.
LARGE_LIST_BYTES = 32_000_000


def read_messages(
    spark: SparkSession,
    path: str,
    layout: str = "lines",
    amount: int | None = None,
    large_list_bytes: int = LARGE_LIST_BYTES,
) -> DataFrame:
    """Raw messages, one JSON object text per row in column ``raw``.

    ``lines`` reads one message per line; such files split over any number of tasks and are
    the layout for large landings. ``array`` reads files that each hold one JSON list, as a
    single fetch returns; one that holds no list fails the read. A file of up to
    ``large_list_bytes`` is one task's work, a larger one is split over many (json_lists.py): the
    same messages, but not in the order of the list. ``amount`` keeps at most that many messages.
    """
    if layout == "lines":
        raw = spark.read.text(path).select(F.col("value").alias("raw"))
        messages = raw.filter(F.trim("raw") != "")
    elif layout == "array":
        small = spark.read.text(path, wholetext=True).where(F.col("_metadata.file_size") <= large_list_bytes)
        whole = small.select("value", F.from_json("value", "array<string>").alias("items"))
        fault = F.concat(
            F.lit("Expected a list of messages, got: "), F.substring("value", 1, 80)
        )
        is_list = F.ltrim("value", F.lit(" \t\r\n")).startswith("[") & F.col("items").isNotNull() & is_one_value(F.col("value"))
        messages = whole.select(
            F.explode(F.when(is_list, F.col("items")).otherwise(F.raise_error(fault))).alias("raw")
        )
        large = read_large_lists(spark, path, large_list_bytes)
        messages = messages if large is None else messages.unionByName(large)
    else:
        raise ValueError(f"Unknown layout: {layout!r}")
    return messages if amount is None else messages.limit(amount)
