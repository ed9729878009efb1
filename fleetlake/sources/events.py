"""Vehicle messages derived from an ``events`` table, row by row and without chance.

Every event becomes one message. Faults are planted by event number so that every
validation rule and every report has something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ID = "event_id"


def _vin() -> Column:
    text = F.concat(F.lit("VIN"), F.lpad(F.col("user_id").cast("string"), 14, "0"))
    return F.when(F.col(_ID) % 50 != 0, text)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread(events: DataFrame) -> DataFrame:
    """The events dealt evenly over four tasks a core.

    A file is read by at most one task for each of its row groups, which may hold a million rows; what
    is dear for every row should not wait for those few tasks. Only these narrow rows move.
    """
    return events.repartition(4 * events.sparkSession.sparkContext.defaultParallelism, _ID)


def vehicle_messages(events: DataFrame) -> DataFrame:
    """Typed messages with Bronze column names, plus ``event_id``."""
    n = F.col(_ID)
    maker = (
        F.when(n % 3 == 0, F.concat(F.lit("  "), F.col("event_type")))
        .when(n % 3 == 1, F.concat(F.col("event_type"), F.lit(" \t")))
        .otherwise(F.col("event_type"))
    )
    model = (
        F.when(n % 101 == 0, "x'; DROP TABLE t; --")
        .when(n % 103 == 0, "SELECT 1")
        .when(n % 11 != 0, F.concat(F.lit("m"), (n % 7).cast("string")))
    )
    gears = ["P", " r ", "N", "drive", "L", "5", "", "X", None, "NULL", "-1", "6"]
    gear = F.element_at(F.array(*[F.lit(g) for g in gears]), (n % 12 + 1).cast("int"))
    return events.select(
        _ID,
        _vin().alias("vin"),
        maker.alias("manufacturer"),
        model.alias("model"),
        gear.alias("gearPosition"),
        F.when(n % 13 != 0, F.floor("value")).alias("velocity"),
        F.when(n % 5 == 1, "OPEN").when(n % 5 == 3, "CLOSED").alias("frontLeftDoorState"),
        F.when(n % 7 != 0, n % 2 == 0).alias("wipersState"),
        F.when(n % 4 == 0, "LOCKED").when(n % 4 == 1, "UNLOCKED").alias("driverSeatbeltState"),
        F.col("ts").alias("timestamp"),
    )


def raw_messages(events: DataFrame) -> DataFrame:
    """The messages as JSON text (``raw``), some of them faulty, plus ``event_id``.

    Built by plain concatenation, so that another engine can build the same text.
    """
    n = F.col(_ID)

    def text(key: str, value: Column) -> Column:
        quoted = F.concat(F.lit(f', "{key}": "'), value, F.lit('"'))
        return F.coalesce(quoted, F.lit(f', "{key}": null'))

    vin = F.when(n % 37 == 0, F.expr("substring(_vin, 1, 16)")).otherwise(F.lower("_vin"))
    vin = F.when(n % 41 == 0, F.concat(F.lit(" "), vin, F.lit(" "))).otherwise(vin)
    vin = F.when(n % 43 == 0, F.replace(vin, F.lit("0"), F.lit("-"))).otherwise(vin)
    velocity = F.floor("value").cast("string")
    velocity = (
        F.when(n % 29 == 0, F.concat(F.lit('"'), velocity, F.lit('.0"')))
        .when(n % 31 == 0, F.concat(velocity, F.lit(".5")))
        .when(n % 23 == 0, F.concat(F.lit("-"), F.lit("1"), velocity))
        .otherwise(velocity)
    )
    wipers = (
        F.when(n % 7 == 0, "null").when(n % 7 == 1, '"yes"').when(n % 7 == 2, "0").when(n % 7 == 3, "2")
        .otherwise("true")
    )
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    timestamp = (
        F.when(n % 53 == 0, '"not a time"')
        .when(n % 59 == 0, "null")
        .when(n % 19 == 0, F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("string"))
        .when(n % 17 == 0, F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"')))
        .when(n % 2 == 0, F.concat(F.lit('"'), stamp, F.lit('Z"')))
        .when(n % 3 == 0, F.concat(F.lit('"'), stamp, F.lit('+02:00"')))
        .otherwise(F.concat(F.lit('"'), stamp, F.lit('"')))
    )
    model = F.when(n % 61 == 0, F.concat(F.lit(', "model": '), (n % 7).cast("string"))).otherwise(
        text("model", F.concat(F.lit("m"), (n % 7).cast("string")))
    )
    body = F.concat(
        F.when(n % 47 == 0, '"year": 2024').otherwise(
            F.concat(F.lit('"year": 2024'), text("vin", vin))
        ),
        text("manufacturer", F.concat(F.col("event_type"), F.lit(" "))),
        model,
        F.lit(', "velocity": '),
        velocity,
        F.lit(', "wipersState": '),
        wipers,
        F.lit(', "timestamp": '),
        timestamp,
        F.when(n % 67 == 0, ', "gear": "P"').otherwise(""),
        F.when(n % 9 == 0, ', "gearPosition": 3').otherwise(', "gearPosition": " d "'),
        F.when(n % 97 == 0, ', "speed": -1.5').when(n % 89 == 0, ', "speed": "12.5"').otherwise(', "speed": 8.25'),
        F.when(n % 101 == 0, ', "rpm": -5').when(n % 103 == 0, ', "rpm": "x"').otherwise(', "rpm": 900'),
        F.when(n % 107 == 0, ', "fuel_level": true').when(n % 109 == 0, ', "fuel_level": "abc"')
        .otherwise(', "fuel_level": 0.5'),
        F.when(n % 113 == 0, ', "engine_temp": [1]').otherwise(', "engine_temp": 90'),
    )
    # Text after the message: more text, a second message, a separator.
    after = F.when(n % 73 == 0, " garbage").when(n % 79 == 0, '{"a": 1}').when(n % 83 == 0, ",").otherwise("")
    raw = F.concat(F.lit("{"), body, F.when(n % 71 == 0, "").otherwise("}"), after)
    return events.withColumn("_vin", _vin()).select(_ID, raw.alias("raw"))
