"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from fleetlake.sources.storage import Storage

# Settings the library sets on any session it runs in; all but the last change results.
RUNTIME_SETTINGS = {
    # Day, hour and partition values are always taken in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object with a repeated key keeps the last value, as JSON readers usually do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Not a matter of results: the JVM compiles no method above 8000 bytes, so a stage whose
    # fused code grows beyond that is faster as separate, smaller projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Defaults for a session we build ourselves; a cluster's own settings win.
BUILD_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "fleetlake",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**BUILD_DEFAULTS, **RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Where the session names none: the user's directory on the default file system, or, in a
    local session, whose executors are this process, a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.partition("[")[0] == "local":
        folder = tempfile.mkdtemp(prefix="fleetlake-")
    return (folder or Storage(spark).home()).rstrip("/")
