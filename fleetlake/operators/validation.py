"""Bronze validation: raw JSON text to typed columns plus an ``errors`` array per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions import coerce
from fleetlake.functions.text import is_one_value, strip, strip_upper
from fleetlake.schemas import BRONZE_FIELDS, BRONZE_REQUIRED_KEYS, ERROR_TYPE

VIN_LENGTH = 17
# Letters and digits of any script.
_ALPHANUMERIC = r"\A[\p{L}\p{N}]+\z"

_READERS = {
    T.StringType(): (coerce.to_text, "string"),
    T.LongType(): (coerce.to_long, "int"),
    T.DoubleType(): (coerce.to_double, "float"),
    T.BooleanType(): (coerce.to_boolean, "bool"),
    T.TimestampType(): (coerce.to_utc_timestamp, "datetime"),
}
_NON_NEGATIVE = ["velocity", "speed", "rpm", "fuel_level", "engine_temp"]


def _error(field: Column | str, code: str, message: Column | str) -> Column:
    return F.struct(
        (F.lit(field) if isinstance(field, str) else field).alias("field"),
        F.lit(code).alias("code"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
    )


def _errors_of(*error) -> Column:
    """An ``errors`` array of one error, or of none."""
    return (F.array(_error(*error)) if error else F.array()).cast(ERROR_TYPE)


_JSON_OPTIONS = {"columnNameOfCorruptRecord": "_malformed", "allowSingleQuotes": "false"}
_NAMES = [n for n, _ in BRONZE_FIELDS]
_TEXT_FIELDS = [n for n, t in BRONZE_FIELDS if t in (T.StringType(), T.TimestampType())]


def _parse_typed(raw: Column) -> Column:
    """Text fields as variants, which keep their JSON type; the others strictly typed.

    A value a strictly typed field cannot hold marks the row as malformed.
    """
    fields = ", ".join(
        f"`{n}` {'variant' if n in _TEXT_FIELDS else t.simpleString()}" for n, t in BRONZE_FIELDS
    )
    return F.from_json(raw, f"{fields}, `_malformed` string", _JSON_OPTIONS)


def _parse_variants(raw: Column) -> Column:
    """Keeps the JSON type of every value: a missing key is NULL, a null value a variant null."""
    fields = ", ".join(f"`{name}` variant" for name in _NAMES)
    return F.from_json(raw, f"{fields}, `_malformed` string", _JSON_OPTIONS)


def _keys(raw: Column) -> Column:
    # json_object_keys refuses the NaN and Infinity literals, the map reader does not.
    return F.coalesce(
        F.json_object_keys(raw), F.map_keys(F.from_json(raw, "map<string,string>"))
    )


def _normalise(name: str, value: Column) -> Column:
    if name == "vin" or name == "gearPosition":
        return strip_upper(value)
    if name == "manufacturer":
        return strip(value)
    return value


def _constraint(name: str, value: Column) -> Column:
    """The errors a well-typed value causes; null values pass."""
    if name == "vin":
        length = F.length(value)
        return (
            F.when(
                length != VIN_LENGTH,
                _errors_of(
                    name,
                    "value_error",
                    F.concat(
                        F.lit(f"VIN must be {VIN_LENGTH} characters, got "), length.cast("string")
                    ),
                ),
            )
            .when(
                ~value.rlike(_ALPHANUMERIC),
                _errors_of(name, "value_error", "VIN must contain only alphanumeric characters"),
            )
            .otherwise(_errors_of())
        )
    if name in _NON_NEGATIVE:
        label = "Velocity" if name == "velocity" else "Value"
        return F.when(
            value < 0,
            _errors_of(
                name,
                "value_error",
                F.concat(F.lit(f"{label} must be non-negative, got "), value.cast("string")),
            ),
        ).otherwise(_errors_of())
    return _errors_of()


def _field_errors(name: str, dtype: T.DataType, kind: Column, text: Column, value: Column) -> Column:
    """At most one error per field: missing, unreadable, or against a rule."""
    _, type_name = _READERS[dtype]
    # A missing optional key and an allowed null are both fine.
    unreadable = value.isNull()
    if name != "timestamp":
        unreadable = unreadable & (kind != "VOID")
    wrong_type = _errors_of(name, f"{type_name}_type", f"Input should be a valid {type_name}")
    if name in BRONZE_REQUIRED_KEYS:
        found = F.when(kind.isNull(), _errors_of(name, "missing", "Field required"))
        found = found.when(unreadable, wrong_type) if type_name == "string" else found
    elif type_name == "string":
        return F.when(unreadable, wrong_type).otherwise(_errors_of())
    else:
        found = F.when(F.lit(False), _errors_of())
    if type_name != "string":
        has_text = kind.isin("STRING", "BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
        unparsed = _errors_of(
            name,
            f"{type_name}_parsing",
            F.concat(F.lit(f"Input should be a valid {type_name}, got "), text),
        )
        found = found.when(unreadable & has_text, unparsed).when(unreadable, wrong_type)
    return found.otherwise(_constraint(name, value))


def validate_messages(df: DataFrame, raw: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the 17 Bronze columns (null where unreadable) and ``errors``.

    A row is valid when ``size(errors) = 0``. Everything is a column expression, so the
    scan, this and a following filter run as one stage without a shuffle.

    Most messages carry the declared JSON types and break no rule. One typed parse reads
    those; only the rest are parsed again and coerced and checked field by field.
    """
    keep = keep or []
    parsed = df.select(
        *keep,
        F.col(raw).alias("_raw"),
        _keys(F.col(raw)).alias("_keys"),
        is_one_value(F.col(raw)).alias("_whole"),
        _parse_typed(F.col(raw)).alias("_p"),
    )
    read = parsed.select(
        *keep,
        "_raw",
        "_keys",
        "_whole",
        _as_declared().alias("_plain"),
        *[_typed_value(n, t).alias(n) for n, t in BRONZE_FIELDS],
    )
    checked = read.select("*", F.coalesce(_flawless(), F.lit(False)).alias("_flawless"))
    # Step by step, so that each step reads columns of the one before; all null for flawless rows.
    flawed = ~F.col("_flawless")
    reparsed = checked.withColumn("_q", F.when(flawed, _parse_variants(F.col("_raw"))))
    described = reparsed.withColumn("_d", F.when(flawed, _describe(F.col("_q")))).drop("_q", "_raw")
    coerced = described.withColumn(
        "_v",
        F.when(
            flawed,
            F.struct(
                *[
                    _normalise(n, _READERS[t][0](F.col(f"_d.k_{n}"), F.col(f"_d.t_{n}"))).alias(n)
                    for n, t in BRONZE_FIELDS
                ]
            ),
        ),
    )
    result = F.struct(
        *[F.when(flawed, F.col(f"_v.{n}")).otherwise(F.col(n)).alias(n) for n in _NAMES],
        F.when(flawed, _errors()).otherwise(_errors_of()).alias("errors"),
    )
    # One row in, one row out. A later filter on ``errors`` is not pushed below a generator,
    # where it would repeat the whole parse.
    judged = coerced.select(*keep, result.alias("_row"))
    return judged.select(*keep, F.explode(F.array("_row")).alias("_r")).select(*keep, "_r.*")


def _as_declared() -> Column:
    """The typed parse lost nothing: no malformed value, text fields hold text or null."""
    plain = F.col("_p").isNotNull() & F.col("_p._malformed").isNull()
    for n in _TEXT_FIELDS:
        kind = F.schema_of_variant(F.col(f"_p.{n}"))
        usual = F.coalesce(kind, F.lit("VOID")).isin("STRING", "VOID")
        # Required keys are present, and the timestamp is not null.
        if n == "timestamp":
            usual = kind == "STRING"
        elif n in BRONZE_REQUIRED_KEYS:
            usual = kind.isin("STRING", "VOID")
        plain = plain & usual
    return plain


def _typed_value(name: str, dtype: T.DataType) -> Column:
    value = F.col(f"_p.{name}")
    if name in _TEXT_FIELDS:
        value = F.try_variant_get(value, "$", "string")
    if dtype == T.TimestampType():
        value = coerce.to_utc_timestamp(F.lit("STRING"), value)
    return _normalise(name, value)


def _flawless() -> Column:
    vin = F.col("vin")
    fine = (
        F.col("_plain")
        & F.col("_whole")
        & F.col("timestamp").isNotNull()
        & (vin.isNull() | ((F.length(vin) == VIN_LENGTH) & vin.rlike(_ALPHANUMERIC)))
        & (F.size(_unknown(F.col("_keys"))) == 0)
    )
    for name in _NON_NEGATIVE:
        fine = fine & F.coalesce(F.col(name) >= 0, F.lit(True))
    return fine


def _unknown(keys: Column) -> Column:
    return F.array_except(keys, F.array(*[F.lit(name) for name in _NAMES]))


def _describe(q: Column) -> Column:
    return F.struct(
        (q.isNull() | q["_malformed"].isNotNull()).alias("bad"),
        *[F.schema_of_variant(q[n]).alias(f"k_{n}") for n in _NAMES],
        *[F.try_variant_get(q[n], "$", "string").alias(f"t_{n}") for n in _NAMES],
    )


def _errors() -> Column:
    unknown = _unknown(F.col("_keys"))
    extra = F.transform(
        unknown, lambda k: _error(k, "extra_forbidden", "Extra inputs are not permitted")
    ).cast(ERROR_TYPE)
    fields = [
        _field_errors(n, t, F.col(f"_d.k_{n}"), F.col(f"_d.t_{n}"), F.col(f"_v.{n}"))
        for n, t in BRONZE_FIELDS
    ]
    return F.when(
        F.col("_d.bad") | ~F.col("_whole"), _errors_of("", "json_invalid", "Message is not a JSON object")
    ).otherwise(F.concat(*fields, F.when(F.size(unknown) > 0, extra).otherwise(_errors_of())))


def error_counts(validated: DataFrame) -> DataFrame:
    """Rows per (field, code); partial aggregation keeps the shuffle tiny."""
    return (
        validated.select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.field").alias("field"), F.col("e.code").alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
