"""Tables for the time of a run, in the folder that all executors reach."""

from __future__ import annotations

import atexit
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

from fleetlake.session import shared_folder
from fleetlake.sources.storage import Storage


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when Python ends: lazy results read it until then."""
    path = f"{shared_folder(spark)}/fleetlake-{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, Storage(spark), path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that what follows neither repeats nor loses its work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(storage: Storage, path: str) -> None:
    with suppress(Exception):  # the session may have ended before
        storage.delete(path)
