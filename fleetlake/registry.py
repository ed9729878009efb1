"""Every query the repository registers, over the given tables or data derived from them."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.gear import GEAR_SPELLINGS, UNKNOWN_GEAR
from fleetlake.functions.gear import gear_number
from fleetlake.functions.patterns import DEFAULT_PATTERN, PATTERN_LIBRARY
from fleetlake.functions.text import is_one_value, strip_unicode
from fleetlake.functions.udf import map_elements
from fleetlake.operators import reports
from fleetlake.operators.injection import find_violations, summarise_scan
from fleetlake.operators.silver import check_silver, drop_null_vins, to_silver
from fleetlake.operators.sizing import estimate_parquet_size_mb, split_by_bytes, split_by_size
from fleetlake.operators.validation import error_counts, validate_messages
from fleetlake.plans.bronze import ingest
from fleetlake.plans.gold import run_gold
from fleetlake.plans.pipeline import run_pipeline
from fleetlake.plans.quarantine import Quarantine
from fleetlake.plans.reports import run_sql
from fleetlake.plans.security import DEFAULT_COLUMNS, run_scan
from fleetlake.plans.silver import run_silver
from fleetlake.schemas import BRONZE_FIELDS
from fleetlake.session import configure
from fleetlake.sinks import partition_text, with_date_hour, write_parquet, write_table, write_unpartitioned
from fleetlake.sources.events import raw_messages, read_events, spread, vehicle_messages
from fleetlake.sources.messages import read_messages
from fleetlake.sources.scratch import scratch_path
from fleetlake.sources.tables import read_silver

Query = Callable[[SparkSession, str], DataFrame]

CHUNK_MB = 0.05
# Caller's own patterns, matched by RE2: a tag pair, a doubled letter run, a look at line ends.
CUSTOM_PATTERNS = [r"<(b|i|em)>[^<]*</", r"\b[A-Z]{3,}\b", r"\d{3}-\d{4}", r"[.!?]$"]


def _ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_messages(read_events(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(_messages(spark, sf_dir))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages(read_events(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_messages(raw_messages(spread(read_events(spark, sf_dir))), keep=["event_id"])


def message_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the messages in both layouts and read them back: as lines, and the well-formed ones
    as lists of up to 500, a file each."""
    base = scratch_path(spark, "landing")
    raw = _raw(spark, sf_dir)
    raw.select("raw").write.text(f"{base}/lines")
    is_message = is_one_value(F.col("raw")) & F.from_json("raw", "map<string,string>").isNotNull()
    lists = (
        raw.where(is_message).groupBy(F.floor(F.col("event_id") / 500).alias("fetch"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("raw"), ", "), F.lit("]")).alias("value"))
    )
    lists.select("value").write.option("maxRecordsPerFile", 1).text(f"{base}/array")
    read = [
        read_messages(spark, f"{base}/{layout}", layout).select(F.lit(layout).alias("layout"), "raw")
        for layout in ("lines", "array")
    ]
    return read[0].unionByName(read[1])


def bronze_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = F.size("errors")
    return _validated(spark, sf_dir).select(
        "event_id", (errors == 0).alias("is_valid"), errors.cast("bigint").alias("n_errors")
    )


def bronze_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_counts(_validated(spark, sf_dir))


def bronze_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _validated(spark, sf_dir)
        .filter(F.size("errors") == 0)
        .select(
            "event_id", "vin", "manufacturer", "year", "model", "velocity", "wipersState",
            _ntz("timestamp"), "gearPosition", "speed", "rpm", "fuel_level", "engine_temp",
        )
    )


def quarantine_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest three batches, one of them twice; the valid messages of each, and all of the quarantine."""
    base = scratch_path(spark, "quarantine")
    raw = _raw(spark, sf_dir)
    counts = []
    for n in (0, 1, 2, 1):
        batch = raw.where(F.col("event_id") % 3 == n).select("raw")
        stats = ingest(batch, f"{base}/bronze", f"{base}/bad", f"b{n}", partition_columns=["date"])
        counts.append((f"b{n}", "good", "", stats.rows))
    good = spark.createDataFrame(sorted(set(counts)), "batch string, kind string, raw_md5 string, n bigint")
    bad = Quarantine(spark, f"{base}/bad").rows()
    return good.unionByName(
        bad.select("batch", F.lit("bad").alias("kind"), F.md5("raw").alias("raw_md5"), F.size("errors").cast("bigint").alias("n"))
    )


def presence_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every reader makes of a table that is there, hidden, empty, or not there."""
    base = scratch_path(spark, "guards")
    rows = _messages(spark, sf_dir)
    rows.write.parquet(f"{base}/there/date=2025-01-01/hour=01")
    rows.write.parquet(f"{base}/hidden/_old")
    rows.limit(0).write.parquet(f"{base}/empty")
    rows.select(F.to_json(F.struct("*"))).write.text(f"{base}/other")
    out = []
    for name in ("there", "hidden", "empty", "other", "nowhere"):
        path = f"{base}/{name}"
        try:
            silver = read_silver(spark, path).count()
        except FileNotFoundError:
            silver = -1
        try:
            scan = run_scan(spark, path)["total_rows_scanned"]
        except FileNotFoundError:
            scan = -1
        bronze = run_silver(spark, path, f"{base}/out-{name}", schema=None, partition_columns=["date"])["input_rows"]
        out.append((name, silver, scan, bronze))
    return spark.createDataFrame(out, "name string, silver_rows bigint, scanned_rows bigint, bronze_rows bigint")


def silver_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that the Silver constraints accept (rows checked) or refuse as a whole (-1)."""
    silver = _silver(spark, sf_dir).drop("event_id")
    cases = {
        "as it is": silver,
        "one column too many": silver.withColumn("colour", F.lit("red")),
        "no vin": silver.drop("vin"),
        "text for a number": silver.withColumn("gear_position", F.col("gear_position").cast("string")),
        "narrow number": silver.withColumn("gear_position", F.col("gear_position").cast("int")),
        "column without values": silver.withColumn("model", F.lit(None)),
    }
    out = []
    for name, table in cases.items():
        try:
            checked = check_silver(table)
            out.append((name, checked.count(), checked.where(F.size("errors") > 0).count()))
        except ValueError:
            out.append((name, -1, -1))
    return spark.createDataFrame(out, "name string, rows bigint, flawed bigint")


def injection_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan that is given columns and patterns it cannot use, which it leaves out with a warning."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found = find_violations(
            _messages(spark, sf_dir), [*DEFAULT_COLUMNS, "colour"], ["(unclosed", DEFAULT_PATTERN, "(?=a)", "a{2,1}"]
        )
    return found.drop("file_path")


def vin_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_vins(_messages(spark, sf_dir)).select("event_id", "vin")


def gear_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).select(
        "event_id", "gearPosition", gear_number(F.col("gearPosition")).alias("gear_position")
    )


def gear_map_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = {t: n for n, texts in GEAR_SPELLINGS.items() for t in texts}

    def number(text: str) -> int:
        return numbers.get(text.strip().upper(), UNKNOWN_GEAR)

    return _messages(spark, sf_dir).select(
        "event_id",
        "gearPosition",
        map_elements(F.col("gearPosition"), number, T.LongType()).alias("gear_position"),
    )


def manufacturer_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).select(
        "event_id", strip_unicode(F.col("manufacturer")).alias("manufacturer")
    )


def silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    return silver.select(*[_ntz(c) if c == "timestamp" else c for c in silver.columns])


def silver_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Shifted so that every constraint meets values on both sides of its bound; the event
    # number travels in ``altitude``, which no constraint looks at.
    n = F.col("event_id")
    shifted = _messages(spark, sf_dir).select(
        n.cast("double").alias("altitude"),
        F.when(n % 19 == 0, " ").otherwise(F.lower("vin")).alias("vin"),
        F.when(n % 17 == 0, "  ").otherwise(F.col("manufacturer")).alias("manufacturer"),
        (n % 10 - 2).alias("gear_position"),
        (F.col("velocity") - 20).alias("rpm"),
        (F.col("velocity") - 10).cast("double").alias("speed"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )
    return check_silver(shifted).select(
        F.col("altitude").cast("bigint").alias("event_id"),
        "vin",
        "manufacturer",
        F.size("errors").cast("bigint").alias("n_errors"),
        F.concat_ws(",", F.array_sort("errors.field")).alias("fields"),
    )


def date_hour_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = with_date_hour(_silver(spark, sf_dir))
    types = {f.name: f.dataType for f in dated.schema.fields}
    return (
        dated.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n"))
        .select(*[partition_text(c, types[c]).alias(c) for c in ("date", "hour")], "n")
    )


def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write Silver partitioned and read the directories back."""
    path = scratch_path(spark, "silver")
    write_table(_silver(spark, sf_dir).drop("event_id"), path)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("date").cast("string").alias("date"), F.col("hour").cast("bigint").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("vin").alias("vins"),
            F.max("velocity").alias("max_velocity"),
            _max_ntz("timestamp"),
        )
    )


def _max_ntz(name: str):
    return F.max(name).cast("timestamp_ntz").alias(name)


def hourly_max_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_max_velocity(_silver(spark, sf_dir))


def fastest_vehicles_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fastest_vehicles_per_hour(_silver(spark, sf_dir))


def fastest_vehicles_by_calendar_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fastest_vehicles_per_hour(
        _silver(spark, sf_dir), by_calendar_date=True
    ).withColumn("date", F.col("date").cast("string"))


def vin_last_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.vin_last_timestamp(_silver(spark, sf_dir)).select("vin", _ntz("max_timestamp"))


def _last_value(column: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        last = reports.last_value_per_vin(_silver(spark, sf_dir), column)
        return last.select("vin", column, _ntz("timestamp"))

    return query


def vin_last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = reports.vin_last_state(_silver(spark, sf_dir))
    return state.withColumn("max_timestamp", _ntz("max_timestamp"))


def vin_last_state_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = reports.vin_last_state_joined(_silver(spark, sf_dir))
    return state.withColumn("max_timestamp", _ntz("max_timestamp"))


ADHOC_SQL = """
WITH readings AS (
  SELECT manufacturer, EXTRACT(DAY FROM timestamp) AS day, velocity, timestamp
  FROM report_table
  WHERE velocity IS NOT NULL
)
SELECT manufacturer, CAST(day AS BIGINT) AS day, COUNT(*) AS readings,
       MAX(velocity) AS top_velocity, CAST(MAX(timestamp) AS {text}) AS last_Timestamp
FROM readings
GROUP BY manufacturer, day;
"""


def adhoc_sql_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = run_sql(_silver(spark, sf_dir), ADHOC_SQL.format(text="STRING"))
    return result.withColumn("last_Timestamp", _ntz("last_Timestamp"))


def injection_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_violations(_messages(spark, sf_dir), DEFAULT_COLUMNS, [DEFAULT_PATTERN])
    return found.drop("file_path")


def injection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise_scan(_messages(spark, sf_dir), DEFAULT_COLUMNS, [DEFAULT_PATTERN])


# Texts with a hit for each shipped pattern, and some without, put after the tables' own texts.
PLANTS = [
    "", "it's 'quoted'", "SELECT it", "/* note */", "-- note", "UNION ALL SELECT", "OR a = b OR", "AND a = b AND",
    "<script>x</script>", "javascript: x", "vbscript: x", "data: x", "plain",
]


def _text_scan(table: str, column: str, patterns: list[str], planted_by: str | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if planted_by:
            plants = F.array(*[F.lit(p) for p in PLANTS])
            plant = F.element_at(plants, (F.expr(planted_by) % len(PLANTS) + 1).cast("int"))
            data = data.withColumn(column, F.concat(F.col(column), F.lit("\n"), plant))
        return find_violations(data, [column], patterns).select(
            "row_index", "file_row_index", "matched_pattern",
            F.md5("column_value").alias("value_md5"),
        )

    return query


def injection_scan_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan a tree of nested plain and key=value folders; read the report table back."""
    base = scratch_path(spark, "folders")
    messages = _messages(spark, sf_dir)
    for n, folder in enumerate(["plain", "plain/deep/er", "keys/shard=1", "keys/shard=2"]):
        messages.where(F.col("event_id") % 4 == n).write.parquet(f"{base}/in/{folder}")
    report = run_scan(spark, f"{base}/in", output_dir=f"{base}/out")
    folder = F.regexp_extract("file_path", r"/in/(.*)/[^/]*$", 1)
    event = F.get_json_object("message_json", "$.event_id").cast("bigint")
    return report["violations"].select(
        folder.alias("folder"), event.alias("event_id"), "column_name", "column_value", "matched_pattern",
        F.lit(report["total_rows_scanned"]).cast("bigint").alias("rows_scanned"),
        F.lit(report["violations_found"]).cast("bigint").alias("violations_found"),
    )


def gold_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run all reports into Gold and read both outputs back, all columns as text."""
    base = scratch_path(spark, "gold")
    write_unpartitioned(_silver(spark, sf_dir), f"{base}/silver")
    run = run_gold(spark, f"{base}/silver", f"{base}/gold")
    read = {}
    for name in run["successful_reports"]:
        read[name] = spark.read.parquet(f"{base}/gold/{name}_*.parquet")
    stamp = F.date_format("max_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    columns = {
        "fastest_vehicles_per_hour": ["date", "hour", "max_velocity_per_vin", "rank"],
        "vin_last_state": [stamp, "front_left_door_state", "wipers_state", F.lit(None)],
    }
    parts = [
        read[name].select(
            F.lit(name).alias("report"), "vin",
            *[(F.col(c) if isinstance(c, str) else c).cast("string").alias(f"v{i}") for i, c in enumerate(of)],
        )
        for name, of in columns.items()
    ]
    return parts[0].unionByName(parts[1])


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports from kept partial results, after a first load, late rows and a corrected day."""
    base = scratch_path(spark, "kept")
    silver = _silver(spark, sf_dir).drop("event_id")
    late = F.dayofmonth("timestamp") % 5 == 0

    def write(rows: DataFrame) -> None:
        write_table(rows, f"{base}/silver", partition_columns=["date"])

    def run() -> dict:
        return run_gold(spark, f"{base}/silver", f"{base}/gold", state_dir=f"{base}/kept")

    # Days that get late rows are wrong at first: some of their rows only, and those too fast.
    write(silver.where(~late | (F.hour("timestamp") < 7)).withColumn("velocity", F.col("velocity") + F.when(late, 1000).otherwise(0)))
    run()
    write(silver.where(late))
    result = run()
    fastest, last = (spark.read.parquet(f"{base}/gold/{n}_*.parquet") for n in ("fastest_vehicles_per_hour", "vin_last_state"))
    stamp = F.date_format("max_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    columns = [[fastest, "date", "hour", "max_velocity_per_vin", "rank"], [last, stamp, "front_left_door_state", "wipers_state", F.lit(None)]]
    reports = [
        table.select(F.lit(name).alias("report"), "vin", *[(F.col(c) if isinstance(c, str) else c).cast("string").alias(f"v{i}") for i, c in enumerate(of)])
        for name, (table, *of) in zip(("fastest_vehicles_per_hour", "vin_last_state"), columns)
    ]
    days = spark.createDataFrame([("days read", d, None, None, None, None) for d in result["days_read"]], reports[0].schema)
    return reports[0].unionByName(reports[1]).unionByName(days)


def custom_partition_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition by gear, replace one partition, write a capped copy; count what is there."""
    base = scratch_path(spark, "gears")
    silver = _silver(spark, sf_dir)
    write_table(silver, f"{base}/gears", partition_columns=["gear_position"])
    again = silver.where((F.col("gear_position") == 3) & (F.col("event_id") % 24 == 3))
    write_table(again, f"{base}/gears", partition_columns=["gear_position"], compression="gzip")
    write_parquet(silver, output_path=f"{base}/capped", max_file_size_mb=0.7, compression="snappy")
    capped = spark.read.parquet(f"{base}/capped").groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
    gears = spark.read.option("inferSchema", "false").schema("vin string, gear_position string").parquet(f"{base}/gears")
    return (
        gears.groupBy(F.col("gear_position").alias("part")).agg(F.count(F.lit(1)).alias("n"))
        .unionByName(capped.agg(F.lit("capped").alias("part"), F.sum("n").alias("n")))
        .unionByName(capped.agg(F.lit("over 700 rows").alias("part"), F.count_if(F.col("n") > 700).alias("n")))
    )


def size_estimate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimate from the rows themselves, with times, nulls and text beyond ASCII."""
    rows = _messages(spark, sf_dir).select(
        "event_id", F.concat(F.col("model"), F.lit("é😀")).alias("model"), "velocity", "wipersState",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )
    return estimate_parquet_size_mb(rows)


def size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return estimate_parquet_size_mb(raw, row_length=F.length("raw"))


def size_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return split_by_size(raw, CHUNK_MB, row_length=F.length("raw")).select("event_id", "chunk_id")


def byte_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    # Some messages above the limit, some above a quarter of it.
    n = F.col("event_id")
    length = F.length("raw") * F.when(n % 997 == 0, 800).when(n % 499 == 0, 250).otherwise(1)
    return split_by_bytes(raw, CHUNK_MB, row_length=length).select("event_id", "chunk_id")


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the messages as JSON lines, run all steps, and report their row counts."""
    base = scratch_path(spark, "pipeline")
    messages = _messages(spark, sf_dir)
    columns = [n for n, _ in BRONZE_FIELDS if n in messages.columns]
    text = F.to_json(
        F.struct(
            *[F.col(c).cast("string").alias(c) if c == "timestamp" else F.col(c) for c in columns]
        ),
        {"ignoreNullFields": "false"},
    )
    messages.select(text.alias("value")).write.text(f"{base}/landing")
    metrics = run_pipeline(spark, f"{base}/landing", base)["run_metrics"]
    counts = [
        "messages_fetched", "input_rows", "filtered_rows", "output_rows", "partitions",
        "total_reports", "total_rows_scanned", "violations_found", "exit_code",
    ]
    return metrics.filter(F.col("metric").isin(counts)).select(
        "step", "metric", F.col("value").cast("bigint").alias("value")
    )


_QUERIES: dict[str, Query] = {
    "message_source": message_source,
    "bronze_validation": bronze_validation,
    "bronze_error_counts": bronze_error_counts,
    "bronze_messages": bronze_messages,
    "quarantine_batches": quarantine_batches,
    "vin_not_null": vin_not_null,
    "gear_map": gear_map,
    "gear_map_elements": gear_map_elements,
    "manufacturer_strip": manufacturer_strip,
    "silver_transform": silver_transform,
    "silver_constraints": silver_constraints,
    "silver_refusals": silver_refusals,
    "presence_guards": presence_guards,
    "date_hour_partitions": date_hour_partitions,
    "partitioned_sink": partitioned_sink,
    "hourly_max_velocity": hourly_max_velocity,
    "fastest_vehicles_per_hour": fastest_vehicles_per_hour,
    "fastest_vehicles_by_calendar_date": fastest_vehicles_by_calendar_date,
    "vin_last_timestamp": vin_last_timestamp,
    "vin_last_door_state": _last_value("front_left_door_state"),
    "vin_last_wipers_state": _last_value("wipers_state"),
    "vin_last_state": vin_last_state,
    "vin_last_state_joined": vin_last_state_joined,
    "adhoc_sql_report": adhoc_sql_report,
    "injection_violations": injection_violations,
    "injection_summary": injection_summary,
    "injection_with_faults": injection_with_faults,
    "injection_scan_pages": _text_scan("pages", "html", [DEFAULT_PATTERN]),
    "pattern_library_pages": _text_scan("pages", "html", list(PATTERN_LIBRARY.values())),
    "pattern_library_documents": _text_scan("documents", "text", list(PATTERN_LIBRARY.values()), "doc_id"),
    "pattern_library_conversations": _text_scan(
        "conversations", "text", list(PATTERN_LIBRARY.values()), "conv_id + turn"
    ),
    "custom_patterns_documents": _text_scan("documents", "text", CUSTOM_PATTERNS),
    "injection_scan_folders": injection_scan_folders,
    "gold_reports": gold_reports,
    "incremental_gold": incremental_gold,
    "custom_partition_sink": custom_partition_sink,
    "size_estimate": size_estimate,
    "size_estimate_rows": size_estimate_rows,
    "size_chunks": size_chunks,
    "byte_chunks": byte_chunks,
    "pipeline_metrics": pipeline_metrics,
}


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _configured(query) for name, query in _QUERIES.items()}
