import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import coerce
from fleetlake.operators.validation import validate_messages

GOOD = {
    "vin": "1HGBH41JXMN109186",
    "manufacturer": "Honda",
    "gearPosition": "D",
    "timestamp": "2025-01-27T10:30:00Z",
}


def check(spark, messages):
    texts = [m if isinstance(m, str) or m is None else json.dumps(m) for m in messages]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw string").coalesce(1)
    return validate_messages(df, keep=["n"]).orderBy("n").collect()


def test_messages(spark):
    cases = [
        (dict(GOOD, velocity=65), []),
        (dict(GOOD, timestamp="2025-01-27T10:30:00"), []),
        (dict(GOOD, vin="INVALID"), [("vin", "value_error")]),
        (dict(GOOD, vin=" 1hgbh41jxmn109186 "), []),
        (dict(GOOD, vin=None), []),
        ({k: v for k, v in GOOD.items() if k != "vin"}, [("vin", "missing")]),
        (dict(GOOD, gear="P"), [("gear", "extra_forbidden")]),
        (dict(GOOD, velocity=-1), [("velocity", "value_error")]),
        (dict(GOOD, rpm=-1), [("rpm", "value_error")]),
        (dict(GOOD, speed=-0.1), [("speed", "value_error")]),
        (dict(GOOD, speed=float("nan")), []),
        (dict(GOOD, speed="nan"), []),
        (dict(GOOD, timestamp=None), [("timestamp", "datetime_type")]),
        (dict(GOOD, model=5), [("model", "string_type")]),
        (dict(GOOD, vin="1HGBH41JXMN10918-"), [("vin", "value_error")]),
        (dict(GOOD, vin="ÄHGBH41JXMN109186"), []),
        (dict(GOOD, model={"vin": 1}), [("model", "string_type")]),
        (dict(GOOD, manufacturer=" Honda\x1c\t"), []),
        ("not json", [("", "json_invalid")]),
        ("[1]", [("", "json_invalid")]),
        (None, [("", "json_invalid")]),
        (dict(GOOD, vin="X", velocity=-3, zzz=1),
         [("vin", "value_error"), ("velocity", "value_error"), ("zzz", "extra_forbidden")]),
    ]
    rows = check(spark, [m for m, _ in cases])
    for row, (message, expected) in zip(rows, cases):
        assert [(e["field"], e["code"]) for e in row["errors"]] == expected, message
    assert rows[1]["timestamp"] == datetime(2025, 1, 27, 10, 30)
    assert rows[2]["errors"][0]["message"] == "VIN must be 17 characters, got 7"
    assert rows[3]["vin"] == GOOD["vin"]
    assert rows[17]["manufacturer"] == "Honda"


KINDS = {str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DOUBLE"}
VALUES = {
    "long": [65, "65", "65.0", " 65 ", "65.5", 65.0, 65.5, True, "true", "+5", "-5", "1_000", "1__0",
             "_1", "1e3", "65.", "0x10", "", ".0", "00065", "\t65\n", "1_0.0", "65.0_0", "+ 5"],
    "double": [1, "1", "1.5", " 1.5 ", "nan", "inf", "-Infinity", "+inf", "1e3", "1_0.5", "abc", "",
               True, "true", "0x1p3", "1.", "  .5", "iNf", "1d", "1f", "1__0", "1e", ".", "+.5", "--1"],
    "boolean": [True, False, 0, 1, 2, 0.0, 1.0, 0.5, "true", "TRUE", " true", "yes", "On", "off", "t",
                "F", "n", "1", "0", "1.0", "", "nO"],
    "datetime": ["2025-01-27T10:30:00Z", "2025-01-27T10:30", "2025-01-27", "2025-01-27 10:30:00",
                 "2025-01-27t10:30:00z", "2025-01-27_10:30:00", "2025-01-27T10:30:00.123456789",
                 "2025-01-27T10:30:00+05:30", "2025-01-27T10:30:00-0530", "2025-01-27T10:30:00+05",
                 "1738000000", "1738000000000", "1738000000.5", 1738000000, 1738000000000,
                 1738000000.25, -1738000000, "20000000000", 20000000001, True,
                 " 2025-01-27T10:30:00Z", "2025-1-27", "2025", "20250127", "2025-02-30",
                 "2025-01-27T24:00:00", "2025-01-27T10:30:60", "0001-01-01", "0000-01-01", "nan",
                 "1e9", "2025-01-27T10:30:00,5", "2025-01-27T10:30:00+23:59",
                 "2025-01-27T10:30:00+24:00", "2025-01-27T10:30:00.", ".5", "-1.5", "5.", "",
                 "2025-01-27T10:30Z", "2025-01-27Z", "253402300800000", "20000000000.5",
                 "2025-01-27T10:30:00−05:00", "+025-01-27T10:30:0Z", "2025-01-27T10:30:00A"],
}


@pytest.mark.parametrize("target", VALUES)
def test_coercion_agrees_with_lax_mode(spark, target):
    pydantic = pytest.importorskip("pydantic")
    python_type = {"long": int, "double": float, "boolean": bool, "datetime": datetime}[target]
    reader = {"long": coerce.to_long, "double": coerce.to_double, "boolean": coerce.to_boolean,
              "datetime": coerce.to_utc_timestamp}[target]
    values = VALUES[target]

    def text(v):
        return str(v).lower() if isinstance(v, bool) else str(v)

    df = spark.createDataFrame(
        [(i, KINDS[type(v)], text(v)) for i, v in enumerate(values)], "i int, k string, t string"
    )
    out = reader(F.col("k"), F.col("t"))
    if target == "datetime":
        out = F.unix_micros(out)
    got = {r["i"]: r["v"] for r in df.select("i", out.alias("v")).collect()}
    for i, value in enumerate(values):
        try:
            expected = pydantic.TypeAdapter(python_type).validate_python(value)
        except pydantic.ValidationError:
            expected = None
        if isinstance(expected, datetime):
            aware = expected if expected.tzinfo else expected.replace(tzinfo=timezone.utc)
            delta = aware - datetime(1970, 1, 1, tzinfo=timezone.utc)
            expected = (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds
        assert repr(got[i]) == repr(expected), value


@pytest.mark.parametrize("after", [" garbage", "{}", ",", "]", "] {}", ', "b": 1', "}", '}, "b": 1}'])
def test_text_after_a_message_is_a_fault(spark, after):
    message = '{"vin": null, "manufacturer": null, "timestamp": "2025-01-27T10:30:00Z"}'
    df = spark.createDataFrame([(message,), (message + after,), (message + " \t",)], "raw string")
    codes = [[e["code"] for e in r["errors"]] for r in validate_messages(df).collect()]
    assert codes == [[], ["json_invalid"], []]


def test_a_constant_message(spark):
    message = '{"vin": null, "manufacturer": null, "timestamp": "2025-01-27T10:30:00Z"}'
    df = spark.range(3).select(F.lit(message).alias("raw"))
    assert [len(r["errors"]) for r in validate_messages(df).collect()] == [0, 0, 0]


def test_text_after_a_list_fails_the_read(spark, tmp_path):
    from fleetlake.sources.messages import read_messages

    (tmp_path / "a.json").write_text('[{"a":1}][{"b":2}]')
    with pytest.raises(Exception, match="Expected a list"):
        read_messages(spark, str(tmp_path), "array").collect()


def test_validation_does_not_wait_for_one_row_group(spark):
    from fleetlake import registry

    # All events are one row group of one file, which one task reads.
    for query in (registry.bronze_validation, registry.bronze_messages):
        rows = query(spark, "/root/testdata/sf0.001").withColumn("task", F.spark_partition_id()).groupBy("task").count()
        sizes = [r["count"] for r in rows.collect()]
        assert len(sizes) >= 2 * spark.sparkContext.defaultParallelism
        assert max(sizes) < sum(sizes) / 4
