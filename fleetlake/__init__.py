"""Vehicle-telemetry lakehouse built on the Spark DataFrame and SQL APIs."""
