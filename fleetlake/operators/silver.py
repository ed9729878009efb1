"""Bronze rows to Silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.gear import VALID_GEARS, gear_number
from fleetlake.functions.text import strip, strip_unicode, strip_upper
from fleetlake.schemas import ERROR_TYPE, SILVER_REQUIRED_COLUMNS, SILVER_SCHEMA

# Columns that leave under a new name, in the order they are appended.
RENAMES = {
    "frontLeftDoorState": "front_left_door_state",
    "wipersState": "wipers_state",
    "driverSeatbeltState": "driver_seatbelt_state",
}


def drop_null_vins(df: DataFrame) -> DataFrame:
    """A blank VIN stays; the not-null test reaches the Parquet scan."""
    return df.filter(F.col("vin").isNotNull())


def pin_utc(c: Column) -> Column:
    """Keep the wall clock and read it as UTC (a no-op for zoned timestamps in a UTC session)."""
    return c.cast("timestamp")


def clean_columns(df: DataFrame) -> DataFrame:
    """Replace in place, drop the raw columns, append the cleaned ones; unknown columns stay."""
    in_place = {
        "manufacturer": strip_unicode(F.col("manufacturer")),
        "timestamp": pin_utc(F.col("timestamp")),
    }
    dropped = {"gearPosition", *RENAMES}
    return df.select(
        *[in_place.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c not in dropped],
        gear_number(F.col("gearPosition")).alias("gear_position"),
        *[F.col(old).alias(new) for old, new in RENAMES.items()],
    )


def to_silver(bronze: DataFrame) -> DataFrame:
    """One narrow stage: filter and project, no Python and no shuffle."""
    return clean_columns(drop_null_vins(bronze))


def _check(name: str, failed: Column, message: Column | str) -> Column:
    return F.when(
        failed,
        F.struct(
            F.lit(name).alias("field"),
            F.lit("value_error").alias("code"),
            (F.lit(message) if isinstance(message, str) else message).alias("message"),
        ),
    )


def check_silver(df: DataFrame) -> DataFrame:
    """Silver constraints: normalised ``vin`` and ``manufacturer`` plus ``errors`` per row.

    Columns that are unknown, or required and absent, are a fault of the table and raise.
    """
    allowed = {f.name: f.dataType for f in SILVER_SCHEMA.fields}
    body = [c for c in df.columns if c not in ("date", "hour")]
    unknown = sorted(set(body) - set(allowed))
    missing = [c for c in SILVER_REQUIRED_COLUMNS if c not in body]
    if unknown or missing:
        raise ValueError(f"Silver columns not allowed: {unknown}; missing: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    # A timestamp without a zone is read as UTC, and a narrower number fits.
    fitting = {("timestamp_ntz", "timestamp"), ("int", "bigint"), ("smallint", "bigint"), ("float", "double")}
    wrong = [
        f"{c} is {types[c].simpleString()}, not {allowed[c].simpleString()}"
        for c in body
        if types[c] != allowed[c]
        and (types[c].simpleString(), allowed[c].simpleString()) not in fitting
        and types[c].simpleString() != "void"
    ]
    if wrong:
        raise ValueError(f"Silver columns of another type: {'; '.join(wrong)}")

    present = set(body)
    blank = strip(F.col("vin")) == ""
    checks = [
        _check("vin", F.col("vin").isNull() | blank, "VIN cannot be null"),
        _check("timestamp", F.col("timestamp").isNull(), "Input should be a valid datetime"),
        _check(
            "gear_position",
            ~F.col("gear_position").isin(VALID_GEARS),
            F.concat(F.lit("Gear position must be -1 to 6, got "), F.col("gear_position").cast("string")),
        ),
    ]
    for name in ("speed", "fuel_level", "engine_temp", "rpm"):
        if name in present:
            value = F.col(name)
            checks.append(
                _check(
                    name,
                    value < 0,
                    F.concat(F.lit("Value must be non-negative, got "), value.cast("string")),
                )
            )
    normal = {
        "vin": F.when(~blank, strip_upper(F.col("vin"))),
        "manufacturer": F.nullif(strip(F.col("manufacturer")), F.lit("")),
    }
    return df.select(
        *[normal.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns],
        F.array_compact(F.array(*checks)).cast(ERROR_TYPE).alias("errors"),
    )
