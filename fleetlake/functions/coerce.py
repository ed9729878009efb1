"""Lax type coercion of JSON values, as column expressions.

A JSON value is described by two columns: ``kind``, the variant type name
(null when the key is missing), and ``text``, the value as text. Each function
returns the coerced value, null where the value is not acceptable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions.text import strip

# The words accepted as booleans, in any letter case.
TRUE_WORDS = ["1", "on", "t", "true", "y", "yes"]
FALSE_WORDS = ["0", "off", "f", "false", "n", "no"]

# Numbers above this size are epoch milliseconds, others epoch seconds;
# the calendar runs from year 1 to year 9999 (bounds in microseconds).
EPOCH_MILLIS_ABOVE = 20_000_000_000
FIRST_MICROS = -62_135_596_800_000_000
LAST_MICROS = 253_402_300_799_999_999

_INT_TEXT = r"\A[+-]?[0-9]+(?:_[0-9]+)*(?:\.0+)?\z"
_FLOAT_TEXT = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
_EPOCH_TEXT = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z"
_ISO_TEXT = (
    r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(?:[Tt _][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?"
    r"(?:[Zz]|[+\-−](?:[01][0-9]|2[0-3]):?[0-5][0-9])?)?\z"
)
_OFFSET = r"([+-])([0-9]{2}):?([0-9]{2})\z"


def is_null(kind: Column) -> Column:
    return kind == "VOID"


def _is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")


def to_text(kind: Column, text: Column) -> Column:
    """Only JSON strings are text; numbers and booleans are refused."""
    return F.when(kind == "STRING", text)


def to_long(kind: Column, text: Column) -> Column:
    trimmed = strip(text)
    whole = F.when(
        trimmed.rlike(_INT_TEXT),
        F.replace(F.substring_index(trimmed, ".", 1), F.lit("_"), F.lit("")).try_cast("bigint"),
    )
    number = text.try_cast("double")
    return (
        F.when(kind == "BIGINT", text.try_cast("bigint"))
        .when(kind == "STRING", whole)
        .when(kind == "BOOLEAN", (text == "true").cast("bigint"))
        .when(_is_number(kind) & (number == F.floor(number)), number.try_cast("bigint"))
    )


def to_double(kind: Column, text: Column) -> Column:
    trimmed = F.lower(strip(text))
    plain = F.replace(trimmed, F.lit("_"), F.lit(""))
    spaced_well = ~(trimmed.startswith("_") | trimmed.endswith("_") | trimmed.contains("__"))
    unsigned = F.ltrim(trimmed, F.lit("+-"))
    sign_ok = F.length(trimmed) - F.length(unsigned) <= 1
    from_words = (
        F.when(spaced_well & plain.rlike(_FLOAT_TEXT), plain.try_cast("double"))
        .when(sign_ok & (unsigned == "nan"), F.lit(float("nan")))
        .when(
            sign_ok & unsigned.isin("inf", "infinity"),
            F.when(trimmed.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
        )
    )
    return (
        F.when(_is_number(kind), text.try_cast("double"))
        .when(kind == "STRING", from_words)
        .when(kind == "BOOLEAN", (text == "true").cast("double"))
    )


def to_boolean(kind: Column, text: Column) -> Column:
    word = F.lower(text)
    number = text.try_cast("double")
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(
            kind == "STRING",
            F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False),
        )
        .when(_is_number(kind) & number.isin(0.0, 1.0), number == 1.0)
    )


def _from_epoch(text: Column) -> Column:
    number = text.try_cast("decimal(30,9)")
    scale = F.when(F.abs(number) > EPOCH_MILLIS_ABOVE, 1_000).otherwise(1_000_000)
    micros = F.round(number * scale, 0)
    in_calendar = micros.between(FIRST_MICROS, LAST_MICROS)
    return F.timestamp_micros(F.when(in_calendar, micros.try_cast("bigint")))


def _is_common_iso(text: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ``, told by its separators: cheaper than the full pattern."""
    shape = (F.length(text) == 20) & (text >= "0001") & text.endswith("Z")
    for position, mark in ((5, "-"), (8, "-"), (11, "T"), (14, ":"), (17, ":")):
        shape = shape & (F.substring(text, position, 1) == mark)
    return shape


def _from_iso(text: Column) -> Column:
    # One spelling for separators, fraction mark, zone letter and minus sign.
    marks = F.translate(text, "t_,z−", "TT.Z-")
    # Seconds may be left out, which a cast accepts only without a zone.
    usual = F.when(
        (F.length(marks) > 16) & (F.substring(marks, 17, 1) != ":"),
        F.concat(F.substring(marks, 1, 16), F.lit(":00"), F.substring(marks, 17, 6)),
    ).otherwise(marks)
    # Offsets beyond 18 hours are outside what a timestamp cast accepts; apply those by hand.
    minutes = F.regexp_extract(usual, _OFFSET, 2).try_cast("bigint") * 60 + F.regexp_extract(
        usual, _OFFSET, 3
    ).try_cast("bigint")
    signed = F.when(F.regexp_extract(usual, _OFFSET, 1) == "-", -minutes).otherwise(minutes)
    local = F.regexp_replace(usual, _OFFSET, "").try_cast("timestamp")
    by_hand = F.timestamp_micros(F.unix_micros(local) - signed * 60_000_000)
    return F.when(_is_common_iso(text), text.try_cast("timestamp")).when(
        text.rlike(_ISO_TEXT),
        F.coalesce(
            usual.try_cast("timestamp"),
            F.when((F.length(usual) > 16) & usual.rlike(_OFFSET), by_hand),
        ),
    )


def to_utc_timestamp(kind: Column, text: Column) -> Column:
    """ISO text (no zone means UTC), a date, or an epoch number; needs a UTC session."""
    return F.when(
        kind == "STRING",
        F.coalesce(_from_iso(text), F.when(text.rlike(_EPOCH_TEXT), _from_epoch(text))),
    ).when(
        _is_number(kind),
        _from_epoch(F.when(kind == "DOUBLE", text.try_cast("double").try_cast("decimal(30,9)"))
                    .otherwise(text.try_cast("decimal(30,9)")).cast("string")),
    )
