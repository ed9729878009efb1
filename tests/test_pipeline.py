import json

import pytest

from fleetlake.plans import quarantine
from fleetlake.plans.bronze import BronzeValidationError, ingest, run_bronze
from fleetlake.plans.pipeline import run_pipeline
from fleetlake.plans.quarantine import Quarantine
from fleetlake.plans.silver import run_silver
from fleetlake.session import shared_folder
from fleetlake.sinks import ParquetWriteError
from fleetlake.sources.messages import read_messages
from fleetlake.sources.storage import Storage


def message(i, **other):
    return {"vin": f"1HGBH41JXMN1{i:05d}", "manufacturer": "Honda ", "gearPosition": "d", "velocity": i,
            "timestamp": f"2025-01-27T{i % 24:02d}:30:00Z", **other}


def land(tmp_path, messages, array=False):
    folder = tmp_path / "landing"
    folder.mkdir()
    text = json.dumps(messages, indent=1) if array else "\n".join(json.dumps(m) for m in messages) + "\n\n"
    (folder / "batch.json").write_text(text)
    return str(folder)


def test_strict_batch(spark, tmp_path, folder):
    bad = [message(i, **({"velocity": -1} if i in (3, 5, 7, 8, 9, 11, 12) else {})) for i in range(15)]
    landing = land(tmp_path, bad)
    with pytest.raises(BronzeValidationError) as error:
        run_bronze(spark, landing, folder)
    assert error.value.count == 7
    assert [s.split(":")[0] for s in error.value.shown] == [f"Message {i}" for i in (3, 5, 7, 8, 9)]
    assert "and 2 more errors" in str(error.value)
    assert not list((tmp_path / folder.split("/")[-1]).rglob("*.parquet"))


def test_positions_over_several_files(spark, tmp_path, folder):
    (tmp_path / "landing").mkdir()
    for n in range(4):
        lines = [json.dumps(message(i, velocity=-1 if i == 7 else 1)) for i in range(10)]
        (tmp_path / "landing" / f"f{n}.json").write_text("\n".join(lines))
    with pytest.raises(BronzeValidationError) as error:
        run_bronze(spark, str(tmp_path / "landing"), folder)
    assert error.value.count == 4
    assert [s.split(":")[0] for s in error.value.shown] == [f"Message {i}" for i in (7, 17, 27, 37)]


def test_quarantine(spark, tmp_path, folder):
    landing = land(tmp_path, [message(i, **({"velocity": -1} if i in (3, 5) else {})) for i in range(15)])
    stats = run_bronze(spark, landing, folder, quarantine_dir=f"{folder}-bad")
    assert (stats["messages_fetched"], stats["messages_quarantined"]) == (13, 2)
    rows = spark.read.parquet(f"{folder}-bad").collect()
    assert len(rows) == 2 and {e["code"] for r in rows for e in r["errors"]} == {"value_error"}


def lines(spark, messages):
    return spark.createDataFrame([(json.dumps(m),) for m in messages], "raw string")


def batch(first, bad):
    return [message(first + i, **({"velocity": -1} if i in bad else {})) for i in range(6)]


def kept(spark, folder):
    """Messages of the table, and (batch, velocity) of those in quarantine."""
    table = spark.read.parquet(f"{folder}/bronze").count() if Storage(spark).has_file(f"{folder}/bronze", ".parquet") else 0
    aside = f"{folder}/bad"
    if not [n for n in Storage(spark).names(aside) if n.startswith("batch=")]:
        return table, []
    return table, sorted((r["batch"], json.loads(r["raw"])["vin"][-5:]) for r in Quarantine(spark, aside).rows().collect())


def test_quarantine_keeps_every_batch(spark, folder):
    for name, first, bad in (("b1", 0, {1}), ("b2", 6, {2, 3}), ("b3", 12, set())):
        stats = ingest(lines(spark, batch(first, bad)), f"{folder}/bronze", f"{folder}/bad", name)
        assert (stats.rows, stats.quarantined) == (6 - len(bad), len(bad))
    both = (15, [("b1", "00001"), ("b2", "00008"), ("b2", "00009")])
    assert kept(spark, folder) == both
    assert Quarantine(spark, f"{folder}/bad").batches() == ["b1", "b2", "b3"]
    assert "_staging" not in Storage(spark).names(f"{folder}/bad") or not Storage(spark).names(f"{folder}/bad/_staging")
    # Given again, a batch replaces its own part alone.
    ingest(lines(spark, batch(6, {2})), f"{folder}/bronze", f"{folder}/bad", "b2")
    assert kept(spark, folder) == (16, [("b1", "00001"), ("b2", "00008")])


@pytest.mark.parametrize("at", ["prepare", "publish", "write_table", "write_unpartitioned"])
def test_a_batch_that_ends_midway_leaves_both_halves_or_neither(spark, folder, monkeypatch, at):
    ingest(lines(spark, batch(0, {1})), f"{folder}/bronze", f"{folder}/bad", "b1")
    before = kept(spark, folder)

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(Quarantine if at in ("prepare", "publish") else quarantine, at, killed)
        with pytest.raises(KeyboardInterrupt):
            ingest(lines(spark, batch(6, {2})), f"{folder}/bronze", f"{folder}/bad", "b2")
    if at != "write_unpartitioned":
        assert kept(spark, folder) == before
    # The next run completes what had been recorded, and nothing else.
    recorded = at != "prepare"
    ingest(lines(spark, batch(12, {0})), f"{folder}/bronze", f"{folder}/bad", "b3")
    expected = [("b1", "00001"), *([("b2", "00008")] if recorded else []), ("b3", "00012")]
    assert kept(spark, folder) == (10 + 5 * recorded, expected)
    assert Quarantine(spark, f"{folder}/bad").recover() == []


def test_quarantine_apart_from_the_table(spark, folder):
    for one, other in ((folder, f"{folder}/bad"), (f"{folder}/x/y", f"{folder}/x"), (folder, folder)):
        with pytest.raises(ParquetWriteError, match="within one another"):
            ingest(lines(spark, batch(0, {1})), one, other)
    with pytest.raises(ParquetWriteError, match="named by"):
        ingest(lines(spark, batch(0, {1})), folder, f"{folder}-bad", "../up")


def test_batches_of_one_kind_only(spark, folder):
    stats = ingest(lines(spark, batch(0, set(range(6)))), f"{folder}/bronze", f"{folder}/bad", "all-bad")
    assert (stats.rows, stats.quarantined) == (0, 6)
    stats = ingest(lines(spark, []), f"{folder}/bronze", f"{folder}/bad", "none")
    assert (stats.rows, stats.quarantined) == (0, 0)
    assert kept(spark, folder)[0] == 0 and len(kept(spark, folder)[1]) == 6


@pytest.mark.parametrize("target", ["file:{}/bronze", "{}/bronze/", "{}/bronze/silver", "{}"])
def test_silver_never_replaces_bronze(spark, tmp_path, folder, target):
    run_bronze(spark, land(tmp_path, [message(1)]), f"{folder}/bronze")
    with pytest.raises(ValueError, match="Silver cannot"):
        run_silver(spark, f"{folder}/bronze", target.format(folder))
    assert spark.read.parquet(f"{folder}/bronze").count() == 1


def test_array_layout_amount_and_empty(spark, tmp_path, folder):
    landing = land(tmp_path, [message(i) for i in range(10)], array=True)
    assert read_messages(spark, landing, "array").count() == 10
    stats = run_bronze(spark, landing, folder, layout="array", amount=4)
    assert (stats["messages_fetched"], stats["partitions"]) == (4, 4)
    (tmp_path / "landing" / "batch.json").write_text("[]")
    assert run_bronze(spark, landing, f"{folder}_2", layout="array")["messages_fetched"] == 0
    (tmp_path / "landing" / "batch.json").write_text('{"vin": null}')
    with pytest.raises(Exception, match="Expected a list"):
        run_bronze(spark, landing, f"{folder}_3", layout="array")


def test_whole_pipeline(spark, tmp_path, folder):
    messages = [message(i) for i in range(48)]
    messages[5]["vin"] = None
    messages[6]["model"] = "x'; DROP TABLE t; --"
    result = run_pipeline(spark, land(tmp_path, messages), folder)
    assert result["bronze"]["messages_fetched"] == 48 and result["bronze"]["partitions"] == 24
    assert result["silver"]["filtered_rows"] == 1 and result["silver"]["output_rows"] == 47
    assert result["gold"]["failed_reports"] == []
    assert result["exit_code"] == 1 and result["scan"]["violations_found"] == 1
    row = json.loads(result["scan"]["violations"].first()["message_json"])
    assert (row["hour"], row["date"], row["timestamp"]) == ("06", "2025-01-27", "2025-01-27T06:30:00+00:00")
    metrics = {(r["step"], r["metric"]): r["value"] for r in result["run_metrics"].collect()}
    assert metrics[("silver", "input_rows")] == 48.0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
