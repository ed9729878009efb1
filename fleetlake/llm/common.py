"""Helpers shared by the operators: scratch tables, Arrow maps, document identifiers."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space as all operators see it: the six ASCII characters.
SPACE = " \t\n\x0b\x0c\r"
# Bytes of text an operator turns into arrays at once; a longer text is a block of its own.
BLOCK_BYTES = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach: ``spark.checkpoint.dir`` of the session.

    Only where the session names none (a local session, as in tests) a temporary one is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone; its files are the cluster's to clean
        pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation. The table is
    deleted when Python ends, since lazy results may read it until then.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    Spark's cleaner deletes them once the driver has collected the plans they belong to, which by
    itself happens every half hour; with large shuffles that keeps each step's files on disk.
    """
    gc.collect()
    spark._jvm.System.gc()


def blocks(
    batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``limit`` bytes of ``text``, and those texts as UTF-8."""
    for batch in batches:
        texts: list[bytes] = []
        first, size = 0, 0
        for at in range(0, batch.num_rows, 64):
            for text in batch.column("text").slice(at, 64).to_pylist():
                text = text.encode() if text else b""
                if size and size + len(text) > limit:
                    yield batch.slice(first, len(texts)), texts
                    first, size, texts = first + len(texts), 0, []
                texts.append(text)
                size += len(text)
        if texts:
            yield batch.slice(first), texts


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo ``modulus``; a null identifier counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
