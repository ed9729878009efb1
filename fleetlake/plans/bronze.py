"""Landing files to the Bronze table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators.validation import validate_messages
from fleetlake.plans.quarantine import ingest_split
from fleetlake.sinks import ParquetWriteError, write_table
from fleetlake.sources.messages import read_messages
from fleetlake.sources.storage import Storage

SHOWN_ERRORS = 5
_GATE = "bronze validation failed"
# monotonically_increasing_id has the partition above these bits.
_PART_BITS = 33


class BronzeValidationError(ParquetWriteError):
    """The batch holds invalid messages; nothing of it was written."""

    def __init__(self, count: int, shown: list[str]):
        self.count = count
        self.shown = shown
        text = f"Validation failed for {count} messages:\n" + "\n".join(shown)
        if count > len(shown):
            text += f"\n... and {count - len(shown)} more errors"
        super().__init__(text)


def gate(validated: DataFrame) -> DataFrame:
    """All or nothing: the first invalid row fails the job that reads the result.

    The check rides on the ``timestamp`` column, which every write needs, so a valid batch is
    validated and written in one pass, and a failed job commits nothing.
    """
    valid = F.size("errors") == 0
    checked = F.when(valid, F.col("timestamp")).otherwise(F.raise_error(F.lit(_GATE)))
    return validated.withColumn("timestamp", checked.cast("timestamp")).drop("errors")


def validation_error(messages: DataFrame) -> BronzeValidationError | None:
    """The count of invalid messages and the first few, by their position in the batch.

    Positions count the messages in the order Spark reads them, over all files: a message's
    place in its partition plus the messages of the partitions before it.
    """
    numbered = messages.withColumn("index", F.monotonically_increasing_id())
    bad = validate_messages(numbered, keep=["index"]).filter(F.size("errors") > 0)
    seen = Observation()
    first = (
        bad.select("index", "errors").observe(seen, F.count(F.lit(1)).alias("count"))
        .orderBy("index").limit(SHOWN_ERRORS).collect()
    )
    if not first:
        return None
    sizes = numbered.groupBy(F.shiftright("index", _PART_BITS).alias("part")).count().collect()
    before = {r["part"]: sum(s["count"] for s in sizes if s["part"] < r["part"]) for r in sizes if any(
        f["index"] >> _PART_BITS == r["part"] for f in first
    )}
    shown = [
        f"Message {before[row['index'] >> _PART_BITS] + (row['index'] & (1 << _PART_BITS) - 1)}: "
        + "; ".join(f"{e['field']}: {e['message']} [{e['code']}]" for e in row["errors"])
        for row in first
    ]
    return BronzeValidationError(seen.get["count"], shown)


def ingest(
    messages: DataFrame,
    output_dir: str,
    quarantine_dir: str | None = None,
    batch_id: str | None = None,
    **write_options,
):
    """Validate a batch of raw messages and write it; returns the write statistics.

    A batch with an invalid message is refused as a whole, unless ``quarantine_dir`` names a
    place for such messages and their errors (quarantine.py).
    """
    if quarantine_dir is not None:
        return ingest_split(messages, output_dir, quarantine_dir, batch_id, **write_options)
    try:
        return write_table(gate(validate_messages(messages)), output_dir, **write_options)
    except Exception as error:
        # Only a failing batch pays for a second pass, which counts and lists its faults.
        if _GATE in str(error):
            fault = validation_error(messages)
            if fault is not None:
                raise fault from error
        raise


def run_bronze(
    spark: SparkSession,
    landing_path: str,
    output_dir: str,
    *,
    layout: str = "lines",
    amount: int | None = None,
    **write_options,
) -> dict:
    """Ingest the landing files; no messages at all is a completed run with zeros."""
    started = time.time()
    zeros = {
        "status": "completed",
        "messages_fetched": 0,
        "files_written": 0,
        "partitions": 0,
        "duration_ms": 0,
    }
    storage = Storage(spark)
    if not storage.exists(landing_path):
        raise FileNotFoundError(f"Landing path not found: {landing_path}")
    stats = ingest(read_messages(spark, landing_path, layout, amount), output_dir, **write_options)
    if write_options.get("quarantine_dir") is not None:
        zeros["messages_quarantined"] = stats.quarantined
    if stats.rows == 0:
        return zeros
    return {
        **zeros,
        "messages_fetched": stats.rows,
        "files_written": stats.files_written,
        "partitions": stats.partitions,
        "duration_ms": round((time.time() - started) * 1000, 2),
    }
