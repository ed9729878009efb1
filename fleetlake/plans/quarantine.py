"""Batches split into a table and a quarantine, both or neither.

A batch is validated once, in one pass that writes its valid and its invalid rows to a staging folder. A
record of the batch, written in one step, is the point from which the batch counts. Only then are
both halves published: the valid rows replace the partitions they touch, the invalid rows become a folder
of their own in the quarantine, which so keeps every batch. What ends before the record leaves neither
half; what ends after it is completed by the next run (``recover``), in the order of the records.

Below the quarantine's folder: ``batch=<id>/`` (``raw``, ``errors``), ``_staging/<id>/`` and ``_batches/``
with a record per batch, ``<id>.prepared`` until both halves are there and ``<id>.done`` after that. One
batch at a time may be written to a table.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators.validation import validate_messages
from fleetlake.sinks import ParquetWriteError, WriteStats, write_table, write_unpartitioned
from fleetlake.sources.storage import Storage

_GOOD, _BAD = "good", "bad"
_HALF = "__half"


@dataclass
class SplitStats(WriteStats):
    """Of the valid half, and how many messages went to the quarantine."""

    quarantined: int = 0


class Quarantine:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.storage = spark, path.rstrip("/"), Storage(spark)

    def _staging(self, batch: str) -> str:
        return f"{self.path}/_staging/{batch}"

    def _record(self, batch: str, state: str) -> str:
        return f"{self.path}/_batches/{batch}.{state}"

    def batches(self, state: str = "done") -> list[str]:
        """Identifiers of the batches in a state, in the order in which they were recorded."""
        records = []
        for name in self.storage.names(f"{self.path}/_batches", f".{state}"):
            batch = name.removesuffix(f".{state}")
            records.append((self._read(batch, state)["recorded"], batch))
        return [batch for _, batch in sorted(records)]

    def _read(self, batch: str, state: str) -> dict:
        return json.loads(self.storage.read_text(self._record(batch, state)))

    def stage(self, messages: DataFrame, batch: str) -> None:
        """Validate the batch and write both halves, in one pass, where no reader looks."""
        validated = validate_messages(messages, keep=["raw"])
        fine = F.size("errors") == 0
        halves = validated.withColumns(
            {
                _HALF: F.when(fine, _GOOD).otherwise(_BAD),
                "timestamp": F.when(fine, F.col("timestamp")),
                "raw": F.when(~fine, F.col("raw")),
                "errors": F.when(~fine, F.col("errors")),
            }
        )
        # No row moves here; the valid ones are dealt to their partitions when they are published.
        halves.write.mode("overwrite").partitionBy(_HALF).parquet(self._staging(batch))

    def prepare(self, batch: str, output_dir: str, options: dict) -> None:
        """Record the staged batch: from here on it will be published, whatever happens."""
        record = {"output_dir": output_dir, "options": options, "recorded": datetime.now(timezone.utc).isoformat()}
        self.storage.write_text(self._record(batch, "prepared"), json.dumps(record))

    def publish(self, batch: str) -> SplitStats:
        """Bring both halves of a prepared batch to where they belong; may be repeated."""
        record = self._read(batch, "prepared")
        stats, bad = WriteStats(), 0
        if self.storage.has_file(self._staging(batch), ".parquet"):
            staged = self.spark.read.parquet(self._staging(batch))
            good = staged.where(F.col(_HALF) == _GOOD).drop(_HALF, "raw", "errors")
            stats = write_table(good, record["output_dir"], **record["options"])
            flawed = staged.where(F.col(_HALF) == _BAD).select("raw", "errors")
            bad = write_unpartitioned(flawed, f"{self.path}/batch={batch}").rows
        if not bad:  # of a batch given again, what it held before
            self.storage.delete(f"{self.path}/batch={batch}")
        self.storage.write_text(self._record(batch, "done"), json.dumps(record | {"rows": stats.rows, "quarantined": bad}))
        self.storage.delete(self._record(batch, "prepared"))
        self.storage.delete(self._staging(batch))
        return SplitStats(**stats.as_dict(), quarantined=bad)

    def recover(self) -> list[str]:
        """Complete the batches that an earlier run has recorded but not published."""
        unfinished = [b for b in self.batches("prepared")]
        for batch in unfinished:
            self.publish(batch)
        return unfinished

    def rows(self) -> DataFrame:
        """``batch``, ``raw`` and ``errors`` of every message in quarantine."""
        return self.spark.read.parquet(self.path)


def ingest_split(
    messages: DataFrame, output_dir: str, quarantine_dir: str, batch_id: str | None = None, **write_options
) -> SplitStats:
    """Write the valid messages of a batch to the table and the others to the quarantine.

    The quarantine keeps earlier batches; a batch given again under its ``batch_id`` replaces its
    own part. Batches left unfinished by an earlier run are completed first.
    """
    spark = messages.sparkSession
    storage = Storage(spark)
    table, apart = (f"{storage.qualified(p)}/" for p in (output_dir, quarantine_dir))
    if table.startswith(apart) or apart.startswith(table):
        raise ParquetWriteError("The quarantine and the table cannot lie within one another")
    batch = batch_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") + f"-{uuid.uuid4().hex[:8]}"
    if not re.fullmatch(r"[0-9A-Za-z][0-9A-Za-z_.-]*", batch):
        raise ParquetWriteError(f"A batch is named by letters, digits, '-', '_' and '.', not {batch!r}")
    quarantine = Quarantine(spark, quarantine_dir)
    quarantine.recover()
    quarantine.stage(messages, batch)
    quarantine.prepare(batch, output_dir, write_options)
    return quarantine.publish(batch)
