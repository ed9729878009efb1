"""BagMinHash, fuzzy lines, linking and the pipeline, against brute force."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import odd_texts, table, words

import corpus_pipeline
from fleetlake.llm import bagminhash, components, fuzzy_lines, linking, queries
from fleetlake.llm.text import Words

SF = "/root/testdata/sf0.001"


class Classes:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)]
    expected = Classes({x for e in edges for x in e})
    for a, b in edges:
        expected.join(a, b)
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    ends = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["id"]: r["label"] for r in got.collect()} == {x: expected.find(x) for x in ends}


def test_linking_tests_few_pairs_and_loses_no_class(spark):
    # One bucket holds chains, where only neighbours are linked; another many of one kind.
    rows = [(1, i) for i in range(300)] + [(2, i) for i in range(1000, 1600)]
    members = linking.shared_buckets(spark.createDataFrame(rows, "bucket long, id long"))
    texts = spark.createDataFrame([(i, str(i).encode()) for _, i in rows], "id long, text binary")

    def test(one, other):
        a, b = np.array([int(x) for x in one])[:, None], np.array([int(x) for x in other])[None, :]
        chain = (abs(a - b) == 1) & (np.maximum(a, b) % 20 != 0)
        return np.where((a < 1000) & (b < 1000), chain, (a >= 1000) & (b >= 1000))

    got = {r["id"]: r["label"] for r in linking.link(members, texts, test).collect()}
    assert got == {i: i // 20 * 20 for i in range(300)} | {i: 1000 for i in range(1000, 1600)}


def bag(text, k=5):
    w = words(text)
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def jaccard(a, b):
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 1.0


def plain_classes(docs, threshold=0.8):
    bags = {i: bag(t) for i, t in docs}
    classes = Classes(bags)
    where = defaultdict(set)
    for i, b in bags.items():
        for k in b or [None]:
            where[k].add(i)
    for x, y in {p for m in where.values() for p in itertools.combinations(sorted(m), 2)}:
        if jaccard(bags[x], bags[y]) >= threshold:
            classes.join(x, y)
    return {i: classes.find(i) for i in bags}


def test_signature_estimates_weighted_jaccard():
    rng = random.Random(2)
    a = [f"w{rng.randrange(400)}" for _ in range(300)] * 2 + ["x y z"] * 30
    b = a[:500] + [f"w{rng.randrange(400)}" for _ in range(60)] + ["x y z"] * 25
    texts = [" ".join(a).encode(), " ".join(b).encode()]
    size = 1 << 14
    got = bagminhash.signatures(*bagminhash.bags(Words(texts), 5), 2, size)
    true = jaccard(bag(texts[0].decode()), bag(texts[1].decode()))
    assert abs((got[0] == got[1]).mean() - true) < 4 * (true * (1 - true) / size) ** 0.5


def near_copies(seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    texts = []
    for i in range(40):
        copy = list(base)
        for _ in range(i % 5):
            copy[rng.randrange(120)] = f"v{rng.randrange(3000)}"
        texts.append(" ".join(copy))
    return texts + ["a b c d e f " * n for n in (5, 6, 7, 12)]


def test_near_classes(spark):
    texts = odd_texts() + near_copies()
    docs = table(spark, texts)
    rows = bagminhash.near_classes(docs).collect()
    expected = plain_classes(list(enumerate(texts)))
    sizes = Counter(expected.values())
    for r in rows:
        assert r["class_id"] == expected[r["doc_id"]]
        assert r["class_size"] == sizes[r["class_id"]] and r["kept"] == (r["doc_id"] == r["class_id"])
    left = bagminhash.keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(sizes)


def test_near_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = plain_classes(docs)
    assert {r["doc_id"]: r["class_id"] for r in queries.op5_bagminhash(spark, SF).collect()} == expected


def test_near_edges(spark):
    docs = table(spark, ["a b", "a b", "a  b", "c"], ids=[None, 3, 3, 3])
    got = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in bagminhash.near_classes(docs).collect()), key=repr)
    assert got == sorted([(None, None, True), (3, None, False), (3, None, False), (3, 3, True)], key=repr)
    assert bagminhash.near_classes(table(spark, [])).count() == 0
    assert bagminhash.keep_one_of_each(table(spark, [])).count() == 0


def levenshtein(a, b):
    # What both begin or end with takes no edit.
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[n:], b[n:]
    n = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - n], b[: len(b) - n]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(9))] for _ in "ab")
        most = rng.randrange(9)
        assert fuzzy_lines.edit_distance(a, b, most) == min(levenshtein(a, b), most + 1)


def plain_lines(docs):
    """Brute force by edit similarity alone: what is linked no longer depends on SimHashes."""
    from test_near_lines import plain_near_lines

    return plain_near_lines(docs)


def test_lines(spark):
    rng = random.Random(5)
    long = [f"w{i}" for i in range(60)]
    texts = [t for t in odd_texts()]
    for i in range(30):
        line = list(long)
        if i % 3:
            line[rng.randrange(60)] = f"v{i}"
        texts.append(f"Title {i}!\n{' '.join(line)}\n\nsame line\n  Same   LINE.  ")
    docs = table(spark, texts)
    got = {r["doc_id"]: r for r in fuzzy_lines.remove_lines(docs).collect()}
    for d, (removed, text) in plain_lines(list(enumerate(texts))).items():
        assert got[d]["__n_removed"] == removed
        assert (got[d]["text"] or "").encode() == text and (got[d]["text"] is None) == (texts[d] is None)
        assert got[d]["key"] == "x"  # other columns pass


def test_lines_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = plain_lines(docs)
    for r in queries.op8_simhash_lines(spark, SF).collect():
        removed, text = expected[r["doc_id"]]
        assert (r["n_removed"], r["kept_sha256"]) == (removed, hashlib.sha256(text).hexdigest())


def test_line_edges(spark):
    docs = table(spark, ["x y\nz", "x y\nz", "z", None], ids=[2, 2, 1, None])
    got = sorted(((r["doc_id"], r["text"]) for r in fuzzy_lines.remove_lines(docs).collect()), key=repr)
    assert got == sorted([(2, "x y"), (2, "x y"), (1, "z"), (None, None)], key=repr)
    assert fuzzy_lines.remove_lines(table(spark, [])).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = queries.documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        out.append((name, docs))
    return out


def test_pipeline_stages(spark, stages):
    raw = queries.documents(spark, SF)
    before = raw.collect()
    for name, docs in stages[:-1]:
        assert docs.dtypes == raw.dtypes
        rows = docs.collect()
        if name == "quality_rules":
            judged = {r["doc_id"]: r["kept"] for r in queries.op2_learned_decision_list(spark, SF).collect()}
            assert {r["doc_id"] for r in rows} == {d for d, kept in judged.items() if kept}
        elif name == "line_dedup":
            expected = plain_lines([(r["doc_id"], r["text"]) for r in before])
            assert {r["doc_id"]: r["text"].encode() for r in rows} == {d: t for d, (_, t) in expected.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "near_dedup":
            classes = plain_classes([(r["doc_id"], r["text"]) for r in before])
            assert {r["doc_id"] for r in rows} == set(classes.values())
        else:
            total, taken = (sum(len(words(r["text"])) for r in part) for part in (before, rows))
            assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in before}
            assert taken <= corpus_pipeline.MIX_BUDGET_SHARE * total
        before = rows


def test_pipeline_packs_what_is_left(spark, stages):
    docs = {r["doc_id"] for r in stages[-2][1].collect()}
    assert {r["doc_id"] for r in stages[-1][1].collect()} == docs
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(tuple, stages[-1][1].select("doc_id", "start", "ids_crc32").collect())
    )


def test_links_of_a_block_only_connect():
    # 40 items on either side, all linked: 1,600 links, of which 79 are enough.
    a, b = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(100, 140)))
    kept = linking._forest(a, b)
    assert len(kept) == 79
    classes = Classes([*range(40), *range(100, 140)])
    for x, y in zip(a[kept].tolist(), b[kept].tolist()):
        classes.join(x, y)
    assert {classes.find(x) for x in classes.parent} == {0}


def test_components_read_fewer_edges_every_round(spark, monkeypatch):
    # A long chain with hubs: the edges within a label are gone in the next round.
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(2000)]
    seen = []

    def count(df, name):
        if name == "edges":
            seen.append(df.count())
        return kept(df, name)

    kept = components.stored
    monkeypatch.setattr(components, "stored", count)
    components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert all(later * 2 < earlier for earlier, later in zip(seen, seen[1:]))
    assert seen[-1] == 0


def test_traits_rule_out_pairs_and_change_no_class(spark):
    # Two chains in one bucket; by their traits only near places may be linked.
    rows = [(1, i) for i in range(300)] + [(2, i) for i in range(0, 300, 2)]
    members = linking.shared_buckets(spark.createDataFrame(rows, "bucket long, id long"), at_once=True)
    texts = spark.createDataFrame([(i, str(i).encode()) for i in range(300)], "id long, text binary")
    table_ = spark.createDataFrame([(i, i) for i in range(300)], "id long, place long")
    asked = spark.sparkContext.accumulator(0)

    def may_link(one, other):
        return abs(one[0][:, None] - other[0][None, :]) <= 3

    def test(one, other):
        a, b = np.array([int(x) for x in one])[:, None], np.array([int(x) for x in other])[None, :]
        asked.add(a.size + b.size)
        return (abs(a - b) == 1) & (np.maximum(a, b) % 20 != 0)

    traits = linking.Traits(table_, ["place"], may_link)
    got = {r["id"]: r["label"] for r in linking.link(members, texts, test, traits).collect()}
    assert got == {i: i // 20 * 20 for i in range(300)}
    assert asked.value > 0
