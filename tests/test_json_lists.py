"""Large JSON lists in parallel: the same messages as a whole-text read."""

import json
import random

import pytest

from fleetlake.sources import json_lists
from fleetlake.sources.messages import read_messages


def tricky(rng, n):
    """Items with brackets, commas, quotes and escapes in strings, nested, blank and of other kinds."""
    texts = ["a,b", "[", "]", "}{", '"', '\\"', "\\", "\\\\", ",", '",', "],[", "é中😀", "\n\t", "/", "", '\\",\\"', '{"x":[1,2]}']
    out = []
    for i in range(n):
        kind = rng.randrange(8)
        text = "".join(rng.choice(texts) for _ in range(rng.randrange(6)))
        out.append([{"i": i, text: text, "deep": [[{"k,": [text, {}]}], []]}, text, i, None, True, [text, [i]], {}, -1.5e3][kind])
    return out


@pytest.fixture
def small_blocks(spark, monkeypatch):
    monkeypatch.setattr(json_lists, "BLOCK_BYTES", 40)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def land(tmp_path, texts):
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.json").write_bytes(text.encode() if isinstance(text, str) else text)
    return str(tmp_path)


def both(spark, path):
    return [
        sorted((r["raw"] for r in read_messages(spark, path, "array", large_list_bytes=size).collect()), key=repr)
        for size in (10**9, 0)
    ]


def test_same_as_whole_text(spark, tmp_path, small_blocks):
    rng = random.Random(5)
    lists = [tricky(rng, n) for n in (0, 1, 2, 40, 150)]
    texts = [json.dumps(x) for x in lists] + [json.dumps(lists[3], indent=2, ensure_ascii=False)]
    texts += ["  [ ]\n", "\n[\t{} , [ ] , \"],[\" ]  \n", json.dumps(["x" * 3000, {"y": "," * 500 + "\\" * 31}, "z"])]
    whole, parallel = both(spark, land(tmp_path, texts))
    assert parallel == whole and len(whole) == 2 * 40 + 150 + 3 + 3 + 3


@pytest.mark.parametrize(
    "text",
    ['{"a": [1, 2]}', "[1, 2", "[1, 2]]", "[1, 2] 3", "[1,, 2]", "[1, 2,]", "[,]", '["a, "b"]', "[1, 2][3]", "[{]}", "1, 2",
     '["a", "b]', "[1 2]", "null", ",[1]", "[1],\n", '[{"a":1]}', "[nul, 1]", " , ", '"[1, 2]"'],
)
def test_what_is_no_list_fails(spark, tmp_path, small_blocks, text):
    path = land(tmp_path, [text])
    for size in (10**9, 0):
        with pytest.raises(Exception, match="Expected a list"):
            read_messages(spark, path, "array", large_list_bytes=size).collect()


def test_small_and_large_files_together(spark, tmp_path, small_blocks):
    rng = random.Random(9)
    lists = [tricky(rng, n) for n in (3, 300, 5, 200)]
    path = land(tmp_path, [json.dumps(x) for x in lists])
    got = read_messages(spark, path, "array", large_list_bytes=2_000)
    assert got.count() == 508
    assert sorted((r["raw"] for r in got.collect()), key=repr) == both(spark, path)[0]


def test_blocks_are_spread_and_states_joined_without_broadcast(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(json_lists, "MAX_BROADCAST_BLOCKS", 0)
    path = land(tmp_path, [json.dumps(tricky(random.Random(2), 400))])
    assert spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions() > 5
    whole, parallel = both(spark, path)
    assert parallel == whole


def test_parts_of_one_block():
    parts = json_lists.parts_of(b'[{"a": ["],", 1]}, 2 , "x,', False, 0, False, False)
    assert [t for t, _, _ in parts] == [b'{"a": ["],", 1]}', b" 2 ", b' "x,'] and [p[1:] for p in parts] == [("[", ","), (",", ","), (",", "-")]
    assert json_lists.parts_of(b',y", 3]\n', True, 1, True, True) == [(b',y"', "-", ","), (b" 3", ",", "]")]
