"""Declared schemas of the Bronze, Silver and violation tables."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

# Field names, order and types of a vehicle message.
BRONZE_FIELDS: list[tuple[str, T.DataType]] = [
    ("vin", _STRING),
    ("manufacturer", _STRING),
    ("year", _LONG),
    ("model", _STRING),
    ("gearPosition", _STRING),
    ("velocity", _LONG),
    ("frontLeftDoorState", _STRING),
    ("wipersState", T.BooleanType()),
    ("driverSeatbeltState", _STRING),
    ("timestamp", T.TimestampType()),
    ("speed", _DOUBLE),
    ("rpm", _LONG),
    ("fuel_level", _DOUBLE),
    ("engine_temp", _DOUBLE),
    ("latitude", _DOUBLE),
    ("longitude", _DOUBLE),
    ("altitude", _DOUBLE),
]

# Keys that must be present in a message, though ``vin`` and ``manufacturer`` may be null.
BRONZE_REQUIRED_KEYS = ["vin", "manufacturer", "timestamp"]

BRONZE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in BRONZE_FIELDS])

# Directory keys of the partitioned layout, as Spark types them when it reads the table back.
PARTITION_FIELDS = [T.StructField("date", T.DateType()), T.StructField("hour", T.IntegerType())]

BRONZE_TABLE_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + PARTITION_FIELDS)

_SILVER_RENAMED = {"gearPosition", "frontLeftDoorState", "wipersState", "driverSeatbeltState"}

# Column order of Silver as written: Bronze minus the renamed columns, then the new ones.
SILVER_SCHEMA = T.StructType(
    [f for f in BRONZE_SCHEMA.fields if f.name not in _SILVER_RENAMED]
    + [
        T.StructField("gear_position", _LONG),
        T.StructField("front_left_door_state", _STRING),
        T.StructField("wipers_state", T.BooleanType()),
        T.StructField("driver_seatbelt_state", _STRING),
    ]
)

SILVER_REQUIRED_COLUMNS = ["vin", "manufacturer", "gear_position", "timestamp"]

VIOLATION_SCHEMA = T.StructType(
    [
        T.StructField("file_path", _STRING),
        T.StructField("row_index", _LONG),
        T.StructField("column_name", _STRING),
        T.StructField("column_value", _STRING),
        T.StructField("matched_pattern", _STRING),
        T.StructField("message_json", _STRING),
    ]
)

ERROR_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("field", _STRING),
            T.StructField("code", _STRING),
            T.StructField("message", _STRING),
        ]
    )
)
