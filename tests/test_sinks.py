import json
import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import sizing
from fleetlake.operators import sizing
from fleetlake.operators.sizing import estimate_parquet_size_mb, json_length, split_by_bytes, split_by_size
from fleetlake.sinks import ParquetWriteError, write_parquet, write_table, write_unpartitioned


def frame(spark, rows):
    return spark.createDataFrame(rows, "vin string, timestamp timestamp, region string, n int")


def at(day, hour):
    return datetime(2025, 1, day, hour, 30)


def directories(path):
    return sorted({str(p.parent.relative_to(path)) for p in Path(path).rglob("*.parquet")})


def test_layout_stats_and_overwrite(spark, folder):
    df = frame(spark, [("a", at(27, 7), "x", 1), ("b", at(27, 7), "x", 2), ("c", at(28, 13), "y", 3)])
    stats = write_table(df, folder)
    assert (stats.rows, stats.files_written, stats.partitions) == (3, 2, 2)
    assert directories(folder) == ["date=2025-01-27/hour=07", "date=2025-01-28/hour=13"]
    back = spark.read.parquet(folder)
    assert back.columns == ["vin", "timestamp", "region", "n", "date", "hour"]
    assert {r["hour"] for r in back.collect()} == {7, 13}
    # One partition is replaced, the other stays.
    again = write_table(frame(spark, [("z", at(27, 7), "x", 9)]), folder)
    assert again.partitions == 1
    assert sorted(r["vin"] for r in spark.read.parquet(folder).collect()) == ["c", "z"]


def test_row_cap_and_codec(spark, folder):
    df = frame(spark, [(str(i), at(1, 1), "x", i) for i in range(25)])
    stats = write_table(df, folder, max_file_size_mb=0.01, compression="snappy")
    assert (stats.rows, stats.files_written, stats.partitions) == (25, 3, 1)
    assert spark.read.parquet(folder).count() == 25
    assert all(".snappy." in p.name for p in Path(folder).rglob("*.parquet"))
    with pytest.raises(ParquetWriteError):
        write_table(df, folder, compression="rar")


def test_custom_partition_columns(spark, folder):
    df = frame(spark, [("a", at(1, 5), "7", 1), ("b", at(1, 6), "A", 2), ("c", at(1, 7), "abc", 3), ("d", at(1, 7), None, 4), ("e", at(1, 7), "p/q", 5)])
    stats = write_table(df, folder, partition_columns=["region"])
    assert directories(folder) == ["region=07", "region=0A", "region=__HIVE_DEFAULT_PARTITION__", "region=abc", "region=p%2Fq"]
    assert (stats.files_written, stats.partitions) == (5, 5)
    assert {"date", "hour"} <= set(spark.read.parquet(folder).columns)


def test_unpartitioned_and_empty(spark, folder):
    df = spark.range(30).select(F.col("id").cast("string").alias("a"))
    stats = write_table(df, f"{folder}/plain")
    assert (stats.rows, stats.files_written, stats.partitions) == (30, 1, 1)
    empty = write_unpartitioned(df.limit(0), f"{folder}/empty")
    assert empty.as_dict() == {"rows": 0, "files_written": 0, "partitions": 0, "duration_ms": 0.0}
    assert not Path(f"{folder}/empty").exists()
    assert write_table(frame(spark, []), f"{folder}/none").rows == 0


def test_entry_arguments(spark, folder):
    df = frame(spark, [("a", at(1, 5), "7", 1)])
    with pytest.raises(ParquetWriteError):
        write_parquet(df)
    with pytest.raises(ParquetWriteError):
        write_parquet(df, output_dir="a", output_path="b")
    assert write_parquet(df, output_path=f"{folder}/one.parquet").files_written == 1
    assert directories(f"{folder}/one.parquet") == ["."]
    write_parquet(df, output_dir=f"{folder}/many")
    assert directories(f"{folder}/many") == ["date=2025-01-01/hour=05"]


def test_validator(spark, folder):
    df = frame(spark, [("a", at(1, 5), "7", 1), (None, at(1, 5), "7", 2)])
    with pytest.raises(ParquetWriteError, match="validator"):
        write_parquet(df, output_dir=folder, validation_enabled=True)
    stats = write_parquet(df, output_dir=folder, validation_enabled=True, validator=lambda d: d.where("vin is not null"))
    assert stats.rows == 1


def test_json_length_of_times_and_other_scripts(spark):
    rows = [("é😀", datetime(2025, 1, 27, 10, 30), None), ("a\"b", datetime(2025, 1, 27, 10, 30, 0, 500), 2.5)]
    df = spark.createDataFrame(rows, "t string, at timestamp, x double")
    texts = [{"t": t, "at": f"{a}+00:00", "x": x} for t, a, x in rows]
    got = [r[0] for r in df.select(json_length(df)).collect()]
    assert got == [len(json.dumps(t)) for t in texts]


def test_splitting_does_not_gather_a_file(spark, folder):
    spark.range(100).coalesce(1).write.parquet(folder)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = split_by_size(spark.read.parquet(folder), 0.0001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "Exchange hashpartitioning(__file" in line]
    assert any("__block" in line for line in joins)


# The rows of the size check.
def size_rows():
    return [
        {"vin": f"1HGBH41JXMN{i:06d}", "manufacturer": "Honda", "gear": "D",
         "timestamp": "2025-01-27T10:30:00Z", "speed": 65.5, "rpm": 2500, "fuel_level": 0.75, "engine_temp": 190.0}
        for i in range(1000)
    ]


def test_size_estimate_and_chunks(spark, folder):
    rows = size_rows()
    columns = list(rows[0])
    spark.createDataFrame([tuple(r.values()) for r in rows], columns).repartition(3).write.parquet(folder)
    table = spark.read.parquet(folder)
    estimate = estimate_parquet_size_mb(table).first()
    assert estimate["rows"] == 1000
    assert estimate["estimated_mb"] == pytest.approx(len(json.dumps(rows)) * 0.3 / 1024 / 1024)
    sizes = {r["chunk_id"]: r["count"] for r in split_by_size(table, 0.001).groupBy("chunk_id").count().collect()}
    assert len(sizes) > 1 and sum(sizes.values()) == 1000
    n = int(estimate["estimated_mb"] / 0.001) + 1
    full, rest = divmod(1000, 1000 // n)
    expected = [1000 // n] * full + ([rest] if rest else [])
    assert [sizes[i] for i in range(len(sizes))] == expected
    assert split_by_size(table, 125.0).select("chunk_id").distinct().count() == 1
    assert estimate_parquet_size_mb(table.limit(0)).first()["estimated_mb"] == 0.0
    # More chunks asked for than rows: one row each.
    assert split_by_size(table, 0.00001).groupBy("chunk_id").count().agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("limit_mb, block", [(0.0004, 7), (0.003, 64), (0.02, 1000), (5.0, 10)])
def test_no_chunk_is_above_the_limit(spark, folder, monkeypatch, limit_mb, block):
    monkeypatch.setattr(sizing, "ROWS_PER_BLOCK", block)
    rng = random.Random(block)
    rows = [(i, "x" * rng.choice([0, 1, 5, 40, rng.randrange(900)])) for i in range(600)] + [(600, "x" * 90_000)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "i long, t string").repartition(3).write.parquet(folder)
    table = spark.read.parquet(folder)
    got = split_by_bytes(table, limit_mb, F.length("t"))
    at = got.withColumn("size", F.length("t") + 2)
    limit = int(limit_mb * 1024 * 1024 / 0.3)
    chunks = at.groupBy("chunk_id").agg(F.sum("size").alias("s"), F.count("*").alias("n")).orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in chunks] == list(range(len(chunks))) and sum(r["n"] for r in chunks) == 601
    assert all(r["s"] <= limit or r["n"] == 1 for r in chunks)
    # Chunks are runs in file order, and no more than needed.
    order = table.select("i", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").collect()
    of = {r["i"]: r["chunk_id"] for r in got.collect()}
    ids = [of[r["i"]] for r in order]
    assert ids == sorted(ids)
    light = sum(r["s"] for r in chunks if 4 * r["s"] <= limit or r["n"] > 1)
    heavy = sum(1 for _, t in rows if 4 * (len(t) + 2) > limit)
    assert len(chunks) <= light / (0.75 * limit) + 2 * heavy + 1


def test_byte_chunks_of_nothing(spark, folder):
    spark.createDataFrame([], "t string").write.parquet(folder)
    assert split_by_bytes(spark.read.schema("t string").parquet(folder), 1.0).count() == 0


@pytest.mark.parametrize("codec", ["zstd", "uncompressed"])
def test_files_follow_the_measured_size(spark, folder, codec):
    rng = random.Random(4)
    rows = [(f"{rng.getrandbits(300):x}", rng.random()) for _ in range(20_000)]
    frame_ = spark.createDataFrame(rows, "t string, x double").coalesce(1)
    stats = write_unpartitioned(frame_, folder, max_file_size_mb=0.1, bytes_per_row=None, compression=codec, keep_order=True)
    sizes = sorted(p.stat().st_size for p in Path(folder).glob("*.parquet"))
    assert stats.files_written == len(sizes) > 8
    assert sum(80_000 <= s <= 120_000 for s in sizes) >= len(sizes) - 1
    assert write_table(frame(spark, []), f"{folder}-none", bytes_per_row=None).rows == 0


def test_rows_look_at_few_cuts_however_many_a_block_has(spark, folder, monkeypatch):
    spark.range(20_000, numPartitions=1).selectExpr("id", "repeat('x', 40) AS t").write.parquet(folder)
    seen = {}

    def keep(df, name):
        seen[name] = stored(df, name)
        return seen[name]

    stored = sizing.stored
    monkeypatch.setattr(sizing, "stored", keep)
    table = spark.read.parquet(folder)
    limit_mb = 500 * 0.3 / (1024 * 1024)  # 42 of every row; cuts where 458 are passed
    got = {r["id"]: r["chunk_id"] for r in split_by_bytes(table, limit_mb, F.length("t")).collect()}
    parts = [42 * i // (500 - 42) for i in range(20_000)]
    number = {p: n for n, p in enumerate(sorted(set(parts)))}
    assert got == {i: number[p] for i, p in enumerate(parts)}
    assert seen["chunk-map"].selectExpr("max(size(__cuts)) AS n").first()["n"] <= sizing.ROWS_PER_PIECE * 42 / 458 + 2
