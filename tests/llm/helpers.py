"""Small documents and plain reference implementations."""

import re

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Columns that could clash with names inside the operators.
        *[T.StructField(n, T.StringType()) for n in ("key", "label", "id", "row", "bucket", "n", "tokens")],
    ]
)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def table(spark, texts, ids=None, lang="en", source="s"):
    rows = []
    for i, text in enumerate(texts):
        doc_id = i if ids is None else ids[i]
        rows.append((doc_id, text, lang, source, len(text or ""), *(["x"] * 7)))
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    """Null, empty, blank, short, repeated and long texts."""
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
    return [None, "", " \n\t ", "one", "one", "A b c", "a B c", "é 中文 😀", long, long + " end", "x\n\n x \ny"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
