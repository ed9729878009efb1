"""Run every registered query and its SQL counterpart; print what differs."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normalise(pdf):
    pdf = pdf[sorted(pdf.columns)]
    rows = [
        tuple("NULL" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v) for v in row)
        for row in pdf.astype(object).itertuples(index=False, name=None)
    ]
    return list(pdf.columns), sorted(rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    mine = normalise(entry.queries()[name](spark, sf_dir).toPandas())
    theirs = normalise(con.execute(entry.oracle_sql()[name]).df())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from fleetlake.session import build_session

    sf = sys.argv[1]
    spark = build_session(
        master="local[8]",
        settings={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in sys.argv[2:] or entry.oracle_sql():
        started = time.time()
        try:
            fault = compare(spark, con, name, sf)
        except Exception as error:
            fault = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:36s} {time.time() - started:6.2f}s {fault or 'ok'}", flush=True)
