import json

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetlake.functions.patterns import DEFAULT_PATTERN, PATTERN_LIBRARY, matches, pattern_error
from fleetlake.functions.re2 import to_jvm
from fleetlake.operators import injection
from fleetlake.plans.security import run_scan

COLUMNS = ["vin", "manufacturer", "model"]
MAIN = [
    ("VIN00000000000001", "Alba", "one"),
    ("VIN'; DELETE FROM logs", "Brio", "two"),
    ("VIN00000000000003", "INSERT INTO it", "three"),
    ("VIN00000000000004", "Corvo", "four OR 2=2"),
    ("VIN00000000000005", "Delta;", "five"),
    ("VIN00000000000006", "Erba", "six /* note */"),
]


def save(spark, rows, path, schema="vin string, manufacturer string, model string"):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def test_main_set(spark, folder):
    save(spark, MAIN, f"{folder}/in")
    report = run_scan(spark, f"{folder}/in", output_dir=f"{folder}/out")
    assert (report["total_files_scanned"], report["total_rows_scanned"], report["violations_found"]) == (1, 6, 3)
    rows = report["violations"].collect()
    assert sorted((r["column_name"], r["row_index"]) for r in rows) == [
        ("manufacturer", 0), ("manufacturer", 1), ("vin", 0)]
    vin = next(r for r in rows if r["column_name"] == "vin")
    assert json.loads(vin["message_json"]) == dict(zip(COLUMNS, MAIN[1]))
    assert report["exit_code"] == 1
    lazy = run_scan(spark, f"{folder}/in")
    assert lazy["violations_found"] == lazy["violations"].count() == 3


def test_files_with_other_columns_and_clean_data(spark, folder):
    save(spark, [("a", "x"), ("b", "y;")], f"{folder}/in/p1", "vin string, manufacturer string")
    save(spark, [("c", None, "SELECT"), ("d", "", "ok")], f"{folder}/in/p2")
    # Two directories below one path, read through a glob.
    table = spark.read.option("mergeSchema", "true").parquet(f"{folder}/in/*")
    found = injection.find_violations(table, COLUMNS, [DEFAULT_PATTERN]).collect()
    assert sorted((r["column_name"], r["column_value"]) for r in found) == [("manufacturer", "y;"), ("model", "SELECT")]
    assert len({r["file_path"] for r in found}) == 2
    missing = json.loads(next(r for r in found if r["column_name"] == "manufacturer")["message_json"])
    assert missing == {"vin": "b", "manufacturer": "y;", "model": None}
    save(spark, MAIN[:1], f"{folder}/clean")
    clean = run_scan(spark, f"{folder}/clean", output_dir=f"{folder}/out")
    assert clean["violations_found"] == 0 and clean["exit_code"] == 0
    assert clean["violations"].count() == 0


LAYOUTS = {
    "nested": ["n", "n/sub", "n/sub/deep"],
    "only below": ["sub/a", "sub/b/c"],
    "keys": ["date=2025-01-01/hour=01", "date=2025-01-01/hour=02"],
    "mixed": ["plain", "t/date=2025-01-01/hour=01", "t/date=2025-01-02/hour=02", "date=2025-01-03"],
}


@pytest.mark.parametrize("name", LAYOUTS)
@pytest.mark.parametrize("schema", [None, "vin string, manufacturer string, model string"])
def test_every_file_below_a_path_is_scanned(spark, folder, name, schema):
    for i, place in enumerate(LAYOUTS[name]):
        save(spark, [(f"v{i};", "x", "y"), ("clean", "x", "y")], f"{folder}/{place}/part{i}" if name == "nested" else f"{folder}/{place}")
    given = schema and spark.createDataFrame([], schema).schema
    report = run_scan(spark, folder, schema=given, output_dir=f"{folder}-out")
    n = len(LAYOUTS[name])
    assert (report["total_files_scanned"], report["total_rows_scanned"], report["violations_found"]) == (n, 2 * n, n)
    found = report["violations"].collect()
    assert len({r["file_path"] for r in found}) == n and report["exit_code"] == 1
    if name == "mixed" and schema is None:
        rows = [json.loads(r["message_json"]) for r in found]
        assert sorted(str(r["date"]) for r in rows) == ["2025-01-01", "2025-01-02", "2025-01-03", "None"]
        assert {r["hour"] for r in rows} == {"01", "02", None}


def test_hour_is_padded_only_where_it_names_a_folder(spark, folder):
    save(spark, [("a;", 7)], folder, "vin string, hour int")
    row = injection.find_violations(spark.read.parquet(folder), ["vin"], [";"]).first()
    assert json.loads(row["message_json"])["hour"] == "7"


def test_plain_patterns_run_in_the_jvm(spark, folder):
    save(spark, MAIN, folder)
    table = spark.read.parquet(folder)
    plan = injection.find_violations(table, ["vin"], [r"\b[A-Z]{3}'", r"<(b|i)>[^<]?</"], ordinals=False)
    assert "ArrowEvalPython" not in plan._jdf.queryExecution().executedPlan().toString()
    # Whatever could take more than a few steps from one place of a text is left to RE2.
    for pattern in (r"(a+)+b", r"a.*b", r"a*b", r"\p{L}", r"a{0,999}a{0,999}b", r"(ab)?c", "|".join(["(a|a)" * 12])):
        assert to_jvm(pattern) is None


def test_guards(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_scan(spark, f"{folder}/none")
    with pytest.raises(ValueError, match="columns_to_check cannot be empty"):
        run_scan(spark, folder, columns=[])
    with pytest.raises(ValueError, match="injection_patterns cannot be empty"):
        run_scan(spark, folder, patterns=[])
    empty = tmp_path / "empty"
    empty.mkdir()
    report = run_scan(spark, str(empty))
    assert (report["total_files_scanned"], report["violations_found"]) == (0, 0)


def test_bad_pattern_and_missing_column_are_skipped(spark, folder):
    save(spark, MAIN, f"{folder}/in")
    assert pattern_error("[invalid_regex_pattern") and pattern_error("(?=a)") and not pattern_error("a+")
    with pytest.warns(UserWarning):
        report = run_scan(spark, f"{folder}/in", columns=["vin", "colour"], patterns=["[invalid", r"DELETE\s"])
    assert report["violations_found"] == 1 and len(report["warnings"]) == 2
    with pytest.warns(UserWarning):
        nothing = run_scan(spark, f"{folder}/in", columns=["vin"], patterns=["[invalid"])
    assert (nothing["total_rows_scanned"], nothing["violations_found"]) == (6, 0)


def test_any_type_can_be_scanned(spark, folder):
    spark.range(20).coalesce(1).write.parquet(folder)
    found = injection.find_violations(spark.read.parquet(folder), ["id"], [r"^1\d$"])
    assert sorted(int(r["column_value"]) for r in found.collect()) == list(range(10, 20))


def test_table_may_use_our_column_names(spark, folder):
    names = "file_path string, block string, column_name string, row_index string"
    save(spark, [("f;", "b", "c", "r")], folder, names)
    row = injection.find_violations(spark.read.parquet(folder), ["file_path"], [";"]).first()
    assert row["column_value"] == "f;" and row["file_path"].startswith("file:")
    assert json.loads(row["message_json"]) == {"file_path": "f;", "block": "b", "column_name": "c", "row_index": "r"}


@pytest.mark.parametrize("bound", [injection.MAX_BROADCAST_SHIFTS, 0])
def test_ordinals_over_splits_and_files(spark, folder, monkeypatch, bound):
    monkeypatch.setattr(injection, "MAX_BROADCAST_SHIFTS", bound)
    rows = [("a; DROP" if i % 3 == 0 else "b" * (i % 97), f"m{i % 5};") for i in range(60_000)]
    frame = spark.createDataFrame(rows, "vin string, model string").coalesce(1)
    for part in ("one", "two"):
        frame.write.option("parquet.block.size", "65536").option("parquet.page.size", "4096").parquet(f"{folder}/{part}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        table = spark.read.parquet(f"{folder}/*")
        assert table.rdd.getNumPartitions() > 4
        patterns = [";", DEFAULT_PATTERN, r"^m[12]*;$"]
        found = injection.find_violations(table, ["vin", "model"], patterns).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {
        **{("vin", p): list(range(0, 60_000, 3)) for p in patterns[:2]},
        **{("model", p): list(range(60_000)) for p in patterns[:2]},
        ("model", patterns[2]): [i for i in range(60_000) if i % 5 in (1, 2)],
    }
    got = {}
    for r in found:
        got.setdefault((r["file_path"], r["column_name"], r["matched_pattern"]), []).append((r["row_index"], r["file_row_index"]))
    assert len(got) == 2 * len(expected)
    for (_, column, pattern), pairs in got.items():
        assert sorted(pairs) == list(enumerate(expected[column, pattern]))


def test_one_scan_and_no_text_in_a_shuffle(spark, folder):
    save(spark, MAIN, folder)
    table = injection.with_lineage(spark.read.parquet(folder))
    plan = injection.plan_scan(table, COLUMNS, [DEFAULT_PATTERN, r"a*b", r"(ab)+c"])
    text = injection._hits(table, plan)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text
    hits = injection._hits(table, plan).withColumn("place", F.lit(0))
    counts = injection._shifts(hits)._jdf.queryExecution().optimizedPlan().toString()
    assert "message_json" not in counts.split("Aggregate", 1)[0]
    plain = injection.find_violations(spark.read.parquet(folder), ["vin"], [";"], ordinals=False)
    assert [r["row_index"] for r in plain.collect()] == [1]


TEXTS = ["", "'", "''", "'a'", "a'b", "a'b'c", ";", "DROP", "drop", "DROPS", "xDROP", "éDROP", "_DROP", "DROP_",
         "EXEC", "EXECUTE", "EXECUTED", "INSERT  INTO", "INSERTINTO", "UNION ALL", "UNION", "UNIONS",
         "/* a */", "/*\n*/", "/*/", "/**/", "*/ /*", "/* x\n/* y */", "--", "a -- b", "-- a\nb", "a\n-- b", "-- x\n",
         "a; b\nc", "UNION SELECT", "UNION\nSELECT", "UNION ALL SELECT", "UNION\x0bSELECT", "UNION  ALL\tSELECT",
         "UNIONALL SELECT", "OR a = b OR", "OR=OR", "OR =xOR", "OR a\n= OR", "ORB = OR = OR", "OR = b", "a OR b = c OR d",
         "AND x=y AND", "AND = AND", "<script></script>", "<script>a\n</script>", "<script a>b</script>",
         "<script</script>", "</script><script>", "<scripts >x</script>", "javascript:", "JavaScript:", "vbscript:x",
         "data:", "metadata: data:", "a\r-- b", "-- a\rb", "/*   */", "SELECT ", "éSELECTé"]


def test_patterns_agree_with_re2(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    own = [r"OR\b", r"^a.*$", r"\s--", "[é]", r"\w\W\w", "a|b", r"--.*$", r"\b", r"^$", r".", r"[^\s]", r"(OR|AND) ?=", r"x{0,2}y", r"[\w;]+$"]
    patterns = [DEFAULT_PATTERN, *PATTERN_LIBRARY.values(), *own]
    rows = df.select("i", *[matches(F.col("t"), p).alias(f"p{n}") for n, p in enumerate(patterns)]).collect()
    con = duckdb.connect()
    for row in rows:
        for n, pattern in enumerate(patterns):
            expected = con.execute("SELECT regexp_matches(?, ?)", [TEXTS[row["i"]], pattern]).fetchall()[0][0]
            assert row[f"p{n}"] == expected, (TEXTS[row["i"]], pattern)


def test_long_texts_are_safe(spark):
    n = 100_000
    texts = ["'" + "a" * n, "'" + "'" * n, "/*" * n, "-" * n + "\n", "OR " * n, "<script" * n, "UNION " * n, "DROP_" * n]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    patterns = [DEFAULT_PATTERN, *PATTERN_LIBRARY.values(), r"('(''|[^'])*')x"]
    row = df.agg(*[F.count_if(matches(F.col("t"), p)).alias(f"p{i}") for i, p in enumerate(patterns)]).first()
    assert row["p0"] == 2
