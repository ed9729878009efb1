"""Fuzzy lines against brute force by edit similarity alone."""

import functools
import hashlib
import random

import numpy as np
import pyarrow as pa
from helpers import table
from test_near_duplicates import Classes, levenshtein

from fleetlake.llm import fuzzy_lines, linking, queries

SF = "/root/testdata/sf0.001"


def near_pairs(lines):
    """Places of lines within an edit similarity of 0.9; lengths and shared words rule most out."""
    number = {w: i for i, w in enumerate(dict.fromkeys(w for line in lines for w in line))}
    words = [sum(1 << i for i in {number[w] for w in line}) for line in lines]  # a bit per distinct word
    order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
    for at, a in enumerate(order):
        for b in order[at + 1 :]:
            longest = len(lines[b])
            if 10 * (longest - len(lines[a])) > longest:
                break
            if 10 * max((words[a] & ~words[b]).bit_count(), (words[b] & ~words[a]).bit_count()) > longest:
                continue
            if 10 * levenshtein(lines[a], lines[b]) <= longest:
                yield a, b


def plain_near_lines(docs):
    return _plain_near_lines(tuple(docs))


@functools.cache
def _plain_near_lines(docs):
    first = {}
    for d, text in sorted(docs):
        for j, line in enumerate((text or "").encode().split(b"\n")):
            if w := tuple(fuzzy_lines.normal_words(line)):
                first.setdefault(w, (d, j))
    lines = list(first)
    classes = Classes(range(len(lines)))
    for x, y in near_pairs(lines):
        classes.join(x, y)
    stays = {}
    for i, w in enumerate(lines):
        root = classes.find(i)
        stays[root] = min(stays.get(root, first[w]), first[w])
    number = {w: i for i, w in enumerate(lines)}
    out = {}
    for d, text in docs:
        of = [(j, line, tuple(fuzzy_lines.normal_words(line))) for j, line in enumerate((text or "").encode().split(b"\n"))]
        kept = [line for j, line, w in of if not w or stays[classes.find(number[w])] == (d, j)]
        out[d] = (len(of) - len(kept), b"\n".join(kept))
    return out


def edited(line, edits, rng):
    line = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(line)), rng.randrange(3)
        line[at : at + (kind != 1)] = [] if kind == 0 else [f"v{rng.randrange(9999)}"]
    return line


def near_texts(seed=3):
    """Lines of 9 words and more with as many edits as are allowed, and one more."""
    rng = random.Random(seed)
    lines = []
    for n in (8, 9, 10, 11, 15, 19, 20, 21, 30, 47, 60, 100):
        for words in (3, 5000):
            base = [f"w{rng.randrange(words)}" for _ in range(n)]
            lines += [base, *(edited(base, e, rng) for e in (1, n // 10, n // 10, n // 10 + 1) if e)]
    rng.shuffle(lines)
    return [" ".join(x) for x in lines]


def test_runs_meet_for_every_near_pair():
    lines = [t.encode() for t in near_texts()]
    split = [x.split() for x in lines]
    pairs = [(a, b) for a, b in near_pairs(split) if split[a] != split[b]]
    assert len(pairs) > 50
    k = fuzzy_lines.run_length(0.9)
    some = np.unique(fuzzy_lines.Words(lines).windows(k)[1])[::5]
    for frequent in (np.empty(0, np.uint64), some):
        owner, runs = fuzzy_lines.first_runs(lines, 0.9, frequent)
        of = [set(runs[owner == i].tolist()) for i in range(len(lines))]
        assert all(of[a] & of[b] for a, b in pairs)


def test_runs_meet_in_any_order():
    lines = [t.encode() for t in near_texts()]
    split = [x.split() for x in lines]
    pairs = [(a, b) for a, b in near_pairs(split) if split[a] != split[b]]
    for most in (0, 3, 255):
        levels = np.random.default_rng(most).integers(0, most, fuzzy_lines.SLOTS, np.uint8, endpoint=True)
        owner, runs = fuzzy_lines.first_runs(lines, 0.9, fuzzy_lines.Frequencies(levels))
        of = [set(runs[owner == i].tolist()) for i in range(len(lines))]
        assert all(of[a] & of[b] for a, b in pairs)


def test_runs_of_all_documents_are_counted(spark):
    # 200 runs stand in five of 50,000 documents each. All other runs of their lines are rarer, and enough.
    letters = str.maketrans("0123456789", "ghijklmnop")  # digits would become 0
    words = [[f"s{i}x{m}" for m in range(4)] + [f"w{i}x{j}x{m}" for m in range(25)] for i in range(200) for j in range(5)]
    lines = [" ".join(x).translate(letters) for x in words]
    texts = ["a line" if i % 50 else lines[i // 50] for i in range(50_000)]
    frequent = fuzzy_lines.frequent_runs(table(spark, texts), 0.9)
    _, runs = fuzzy_lines.first_runs([x.encode() for x in lines], 0.9, frequent)
    common = fuzzy_lines.Words([" ".join(x.split()[:4]).encode() for x in lines]).windows(4)[1]
    assert len(set(common.tolist())) == 200 and len(runs) >= 4 * len(lines)
    assert not np.isin(common, runs).any()


def test_near_lines(spark):
    texts = near_texts()
    docs = list(enumerate("\n".join(texts[i : i + 3]) for i in range(0, len(texts), 3)))
    got = {r["doc_id"]: r for r in fuzzy_lines.remove_lines(table(spark, [t for _, t in docs])).collect()}
    expected = plain_near_lines(docs)
    assert sum(removed for removed, _ in expected.values()) > 20
    for d, (removed, text) in expected.items():
        assert (got[d]["__n_removed"], got[d]["text"].encode()) == (removed, text)


def test_near_lines_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = plain_near_lines(docs)
    for r in queries.op8_simhash_lines(spark, SF).collect():
        removed, text = expected[r["doc_id"]]
        assert (r["n_removed"], r["kept_sha256"]) == (removed, hashlib.sha256(text).hexdigest())


def test_one_pass_gives_the_runs_of_first_lines(spark):
    # Lines with and without runs, repeated within a document and across documents of a block.
    texts = near_texts()
    docs = ["\n".join([*texts[i : i + 4], "too short", texts[0]]) for i in range(0, len(texts), 4)] + [None, "", " ,. \n"]
    rows = fuzzy_lines.signed_lines(table(spark, docs).coalesce(1), 0.9, np.empty(0, np.uint64)).collect()
    assert len(rows) == sum(1 for d in docs for line in (d or "").split("\n") if fuzzy_lines.normal_words(line.encode()))
    with_text = [r for r in rows if r["text"] is not None]
    assert len({r["key"] for r in with_text}) == len(with_text)
    assert {r["key"] for r in rows if r["n"] >= 9} == {r["key"] for r in with_text}
    lines = [bytes(r["text"]) for r in with_text]
    owner, runs = fuzzy_lines.first_runs(lines, 0.9, np.empty(0, np.uint64))
    assert [r["runs"] for r in with_text] == [runs[owner == i].view(np.int64).tolist() for i in range(len(lines))]
    assert all(not r["runs"] for r in rows if r["text"] is None)


def test_counts_rule_out_lines_that_share_a_passage():
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(90)]
    lines = [" ".join([f"w{rng.randrange(5000)}" for _ in range(30)] + passage).encode() for _ in range(40)]
    lines += [" ".join(edited(lines[0].decode().split(), n, rng)).encode() for n in (1, 6, 12, 12)]
    near = fuzzy_lines.alike(0.9)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(lines)), np.arange(len(lines))))
    may = near.may_link(lines, a, b)
    linked = np.array([near.linked(lines[x], lines[y]) for x, y in zip(a, b)])
    assert (linked <= may).all() and linked.sum() > len(lines)
    assert (may & ~linked).sum() < 0.02 * len(may)


def test_groups_are_whole_over_batches():
    rng = random.Random(4)
    arena = sorted(rng.randrange(20) for _ in range(200))
    batch = pa.record_batch([pa.array(arena), pa.array(range(200))], names=["arena", "id"])
    cut = [batch.slice(at, 7) for at in range(0, 200, 7)]
    got = []
    for part, bounds in linking._runs_of(iter(cut), ["arena"]):
        for at, to in zip(bounds, bounds[1:]):
            got.append((set(part["arena"][at:to].to_pylist()), part["id"][at:to].to_pylist()))
    assert [x for _, ids in got for x in ids] == list(range(200))
    assert [of for of, _ in got] == [{x} for x in sorted(set(arena))]
