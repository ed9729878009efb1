"""One listing of a tree, and what is read by it."""

import pytest

from fleetlake.sources import tables
from fleetlake.sources.listing import list_tree
from fleetlake.sources.storage import Storage
from fleetlake.sources.tables import has_parquet, read_for_scan, read_silver, read_tree


def save(spark, path, **columns):
    spark.createDataFrame([tuple(columns.values()) or ("v",)], list(columns) or ["vin"]).coalesce(1).write.parquet(path)


CASES = {
    "flat": ([""], True, []),
    "keys": (["date=2025-01-01/hour=01", "date=2025-01-02/hour=02"], True, ["date", "hour"]),
    "uneven keys": (["date=2025-01-01", "date=2025-01-02/hour=02"], False, ["date", "hour"]),
    "plain folders": (["a", "a/b"], False, []),
    "odd names": (["region=p%2Fq r=s", "region=é ü"], True, ["region"]),
    "key below plain": (["x y/date=1", "z/date=2"], False, ["date"]),
}


@pytest.mark.parametrize("name", CASES)
def test_kinds_of_trees(spark, folder, name):
    places, partitioned, keys = CASES[name]
    for place in places:
        save(spark, f"{folder}/t/{place}".rstrip("/"))
    tree = list_tree(spark, f"{folder}/t")
    assert (len(tree), tree.partitioned, tree.keys) == (len(places), partitioned, keys)
    if name != "odd names":
        assert tree.folders == set(places)
    assert read_tree(spark, f"{folder}/t", tree=tree).count() == len(places)


def test_hidden_files(spark, folder):
    for place in ("date=1/hour=1", "_old", ".keep/in", "date=1/_tmp", "_old/_older/deep/er"):
        save(spark, f"{folder}/{place}")
    assert len(list_tree(spark, folder)) == 1 and list_tree(spark, folder).partitioned
    tree = list_tree(spark, folder, hidden=True)
    assert (len(tree.files), len(tree.hidden), tree.partitioned) == (1, 4, False)
    assert read_for_scan(spark, folder).count() == 5
    assert list_tree(spark, f"{folder}/_old", hidden=True).folders == {"", "_older/deep/er"}


def test_nothing_there(spark, folder, tmp_path):
    assert len(list_tree(spark, f"{folder}/none")) == 0 and not has_parquet(spark, f"{folder}/none")
    (tmp_path / "empty" / "sub").mkdir(parents=True)
    (tmp_path / "empty" / "sub" / "notes.txt").write_text("x")
    (tmp_path / "empty" / "_hidden.txt").write_text("x")
    assert len(list_tree(spark, str(tmp_path / "empty"), hidden=True)) == 0
    assert read_for_scan(spark, str(tmp_path / "empty")) is None
    with pytest.raises(FileNotFoundError, match="No Silver data"):
        read_silver(spark, str(tmp_path / "empty"))


def test_many_folders_are_listed_without_a_call_for_each(spark, folder, monkeypatch):
    spark.range(200).selectExpr("id as vin", "id as shard").repartition(4).write.partitionBy("shard").parquet(folder)
    calls = []
    client = type(spark.sparkContext._gateway._gateway_client)
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(1) or send(*a, **k))
    tree = list_tree(spark, folder, hidden=True)
    assert len(tree) == 200 and len(calls) < 150
    assert read_tree(spark, folder, tree=tree).where("shard = 7").count() == 1


def test_one_listing_per_read(spark, folder, monkeypatch):
    save(spark, f"{folder}/date=1/hour=1")
    listed = []
    real = tables.list_tree
    monkeypatch.setattr(tables, "list_tree", lambda *a, **k: listed.append(a) or real(*a, **k))
    assert read_silver(spark, folder).count() == 1
    assert len(listed) == 1


def test_text_files_appear_whole(spark, folder):
    storage = Storage(spark)
    storage.write_text(f"{folder}/a.json", "é\n" * 5000)
    storage.write_text(f"{folder}/a.json", "second")
    assert storage.read_text(f"{folder}/a.json") == "second" and storage.names(folder, ".json") == ["a.json"]
