"""Fill-in-middle against a plain version per text."""

import hashlib
import random
import re

import pytest
from helpers import odd_texts, table

from fleetlake.llm import fill_in_middle, queries

SF = "/root/testdata/sf0.001"


def plain(doc_id, text, seed=7, fim_rate=100, spm_rate=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in marks) or h[2] % 100 >= fim_rate:
        return len(units), "plain", None, None, text, text
    p, s, m = marks
    if h[3] % 100 < spm_rate:
        form, output = "spm", f"{s}{suffix}{p}{prefix}{m}{middle}"
    else:
        form, output = "psm", f"{p}{prefix}{s}{suffix}{m}{middle}"
    return len(units), form, len(prefix), len(middle), output, text


def many_texts():
    rng = random.Random(4)
    odd = ["a\n", "\n", "\n\n", "\n\na", "x<P>y\nz", "<M>", "<\nP>\n<S", "<P\n>", "é\n中文\n😀\n", "a<\nS>b\n<"]
    lines = ["\n".join("w" * rng.randrange(4) for _ in range(rng.randrange(12))) for _ in range(300)]
    return odd_texts() + odd + lines + ["long line\n" * 100_000 + "end", "x" * 3_000_000]


@pytest.mark.parametrize("settings", [{}, {"seed": 3, "fim_rate": 40, "spm_rate": 0}, {"spm_rate": 100, "marks": ("[pre]", "[su]", "[m]")}])
def test_same_as_one_by_one(spark, settings):
    texts = many_texts()
    rows = fill_in_middle.fill_in_middle(table(spark, texts), **settings).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == plain(r["doc_id"], texts[r["doc_id"]], **settings)
    assert {r["form"] for r in rows} >= {"plain", "spm" if settings.get("spm_rate", 50) else "psm"}


def test_null_and_repeated_ids_and_no_rows(spark):
    texts = ["a\nb\nc\nd\n", "a\nb\nc\nd\n", "a\nb\nc\nd\n", None]
    got = fill_in_middle.fill_in_middle(table(spark, texts, ids=[None, 5, 5, 5])).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *plain(i, t))) for i, t in zip([None, 5, 5, 5], texts))
    assert fill_in_middle.fill_in_middle(table(spark, [])).count() == 0


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("aa", "b", "c"), ("ab", "ca", "x"), ("<P>", "<PS>", ""), ("a", "xay", "q")])
def test_marks_that_cannot_be_told_apart(spark, marks):
    with pytest.raises(ValueError):
        fill_in_middle.fill_in_middle(table(spark, ["a"]), marks=marks)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF).collect()}
    rows = queries.op11_fill_in_middle(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, prefix, middle, output, text = plain(r["doc_id"], texts[r["doc_id"]])
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (output, text)]
        assert tuple(r) == (r["doc_id"], n, form, prefix, middle, *digests)
