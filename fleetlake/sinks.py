"""Parquet sinks: partitioned tables, unpartitioned outputs, write statistics."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.text import pad2
from fleetlake.sources.listing import files_in
from fleetlake.sources.scratch import scratch_path
from fleetlake.sources.storage import Storage

# Default layout, codec names, size cap and the assumed size of a row.
DATE_HOUR = ["date", "hour"]
CODECS = ["lz4", "uncompressed", "snappy", "gzip", "lzo", "brotli", "zstd"]
MAX_FILE_SIZE_MB = 125.0
BYTES_PER_ROW = 1_000
# Rows written to scratch to learn their encoded size, where it is asked for.
MEASURED_ROWS = 200_000

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Characters a partition directory name holds as %XX.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(1, 32)}


class ParquetWriteError(Exception):
    """A write that cannot be done as asked."""


@dataclass
class WriteStats:
    rows: int = 0
    files_written: int = 0
    partitions: int = 0
    duration_ms: float = 0.0

    def as_dict(self) -> dict:
        return asdict(self)


def with_date_hour(df: DataFrame) -> DataFrame:
    """Add (or replace) ``date`` and ``hour``, the UTC day and hour of ``timestamp``."""
    return df.withColumn("date", F.to_date("timestamp")).withColumn("hour", F.hour("timestamp"))


def partition_text(name: str, dtype: T.DataType) -> Column:
    """Directory text of a partition value: ISO dates, everything else at least two characters."""
    value = F.col(f"`{name}`")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(dtype, T.BooleanType):
        return F.initcap(value.cast("string"))
    return pad2(value.cast("string"))


def _directory(name: str, value: str | None) -> str:
    if value is None or value == "":
        return f"{name}={_NULL_PARTITION}"
    return name + "=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_columns: list[str] | None = None,
    max_file_size_mb: float = MAX_FILE_SIZE_MB,
    bytes_per_row: int | None = BYTES_PER_ROW,
    compression: str = "zstd",
    clustered: bool = False,
) -> WriteStats:
    """Write ``date=YYYY-MM-DD/hour=HH`` directories, or those of ``partition_columns``.

    Only the partitions the data touches are replaced, and only when the whole job succeeds.
    Rows are rebalanced on the partition columns: each directory goes to one task, a hot one
    is split over several, tiny ones share a task. ``clustered`` skips that shuffle for input
    whose files already hold one partition each. A frame without ``timestamp`` is written
    unpartitioned. Files are cut at ``max_file_size_mb`` by their number of rows, from ``bytes_per_row``;
    None measures it on the first rows.
    """
    _check_codec(compression)
    if "timestamp" not in df.columns:
        return write_unpartitioned(
            df,
            path,
            max_file_size_mb=max_file_size_mb,
            bytes_per_row=bytes_per_row,
            compression=compression,
        )
    started = time.time()
    keys = partition_columns or DATE_HOUR
    dated = with_date_hour(df)
    types = {f.name: f.dataType for f in dated.schema.fields}
    body = [c for c in dated.columns if c not in keys]
    table = dated.select(
        *[F.col(f"`{c}`") for c in body], *[partition_text(k, types[k]).alias(k) for k in keys]
    )
    cap = _row_cap(table, max_file_size_mb, bytes_per_row, compression)
    if not clustered:
        table = table.hint("rebalance", *keys)
    # Last before the write, so that a repeated shuffle stage cannot count rows twice. The set
    # is as large as the list of directories, which the commit holds on the driver anyway.
    seen = Observation()
    table = table.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(
            F.struct(*[F.coalesce(F.col(f"`{k}`"), F.lit("")).alias(f"k{i}") for i, k in enumerate(keys)])
        ).alias("partitions"),
    )
    (
        table.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", cap)
        .partitionBy(*keys)
        .parquet(path)
    )
    touched = ["/".join(_directory(k, v) for k, v in zip(keys, p)) for p in seen.get["partitions"]]
    files = len(files_in(df.sparkSession, [f"{path}/{d}" for d in touched]))
    return WriteStats(seen.get["rows"], files, len(touched), _elapsed_ms(started))


def write_unpartitioned(
    df: DataFrame,
    path: str,
    *,
    max_file_size_mb: float = MAX_FILE_SIZE_MB,
    bytes_per_row: int | None = BYTES_PER_ROW,
    compression: str = "zstd",
    keep_order: bool = False,
) -> WriteStats:
    """Replace ``path`` by a directory of Parquet parts: one part while the data is small.

    An empty frame writes nothing: the statistics are zero, and what an earlier write left at
    ``path`` stays. ``keep_order`` leaves out the rebalancing of parts, for sorted results.
    """
    _check_codec(compression)
    started = time.time()
    storage = Storage(df.sparkSession)
    if storage.exists(path) and df.isEmpty():
        return WriteStats()
    cap = _row_cap(df, max_file_size_mb, bytes_per_row, compression)
    seen = Observation()
    parts = df if keep_order else df.hint("rebalance")
    (
        parts.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", compression)
        .option("maxRecordsPerFile", cap)
        .parquet(path)
    )
    rows = seen.get["rows"]
    if rows == 0:
        storage.delete(path)
        return WriteStats()
    return WriteStats(rows, len(storage.names(path, ".parquet")), 1, _elapsed_ms(started))


def write_parquet(
    df: DataFrame,
    *,
    output_dir: str | None = None,
    output_path: str | None = None,
    partitioning_enabled: bool | None = None,
    partition_columns: list[str] | None = None,
    validation_enabled: bool = False,
    validator: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> WriteStats:
    """One entry for both layouts: ``output_dir`` is partitioned, ``output_path`` is not.

    With ``validation_enabled`` the rows first go through ``validator``, which returns the
    frame to write and may fail rows, as ``gate(validate_messages(df))`` does.
    """
    if validation_enabled:
        if validator is None:
            raise ParquetWriteError("A validator is required when validation is enabled")
        df = validator(df)
    if output_dir is None and output_path is None:
        raise ParquetWriteError("Either output_dir or output_path must be provided")
    if output_dir is not None and output_path is not None:
        raise ParquetWriteError("Provide only one of output_dir or output_path, not both")
    partitioned = output_dir is not None if partitioning_enabled is None else partitioning_enabled
    target = output_dir or output_path
    if partitioned:
        return write_table(df, target, partition_columns=partition_columns, **options)
    return write_unpartitioned(df, target, **options)


def _check_codec(compression: str) -> None:
    if compression not in CODECS:
        raise ParquetWriteError(f"Unknown compression {compression!r}; use one of {CODECS}")


def measured_bytes_per_row(df: DataFrame, compression: str = "zstd", rows: int = MEASURED_ROWS) -> int:
    """Encoded bytes of a row, from files written of the first ``rows`` rows; the assumed size if there
    are none. What it reads is bounded, however large the frame is."""
    path = scratch_path(df.sparkSession, "measured")
    # One file, as small ones are mostly footers and dictionaries.
    df.limit(rows).coalesce(1).write.option("compression", compression).parquet(path)
    files = df.sparkSession.read.schema(df.schema).parquet(path).select("_metadata.file_path", "_metadata.file_size")
    sized = files.groupBy("file_path").agg(F.max("file_size").alias("size"), F.count(F.lit(1)).alias("n"))
    size, n = sized.agg(F.sum("size"), F.sum("n")).first()
    return max(1, round(size / n)) if n else BYTES_PER_ROW


def _row_cap(df: DataFrame, max_file_size_mb: float, bytes_per_row: int | None, compression: str) -> int:
    if bytes_per_row is None:
        bytes_per_row = measured_bytes_per_row(df, compression)
    return max(1, int(max_file_size_mb * 1_000_000 / bytes_per_row))


def _elapsed_ms(started: float) -> float:
    return round((time.time() - started) * 1000, 2)
