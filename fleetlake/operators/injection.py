"""Pattern scan: one pass over a table for any number of columns and patterns."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.patterns import match_all, pattern_error
from fleetlake.schemas import VIOLATION_SCHEMA
from fleetlake.sources.scratch import stored

# A list of shifts of at most this many rows (some 60 MB) is sent to every executor.
MAX_BROADCAST_SHIFTS = 2_000_000

_FILE, _SPLIT, _ROW = "__file_path", "__split", "__row_index"


@dataclass(frozen=True)
class ScanPlan:
    """What will really be scanned, after dropping unusable columns and patterns."""

    columns: list[str]
    patterns: list[str]
    warnings: list[str]


def check_arguments(columns: list[str], patterns: list[str]) -> None:
    if not columns:
        raise ValueError("columns_to_check cannot be empty")
    if not patterns:
        raise ValueError("injection_patterns cannot be empty")


def plan_scan(table: DataFrame, columns: list[str], patterns: list[str]) -> ScanPlan:
    """Columns and patterns that can be used; a warning tells of each of the others."""
    notes = [f"column '{c}' is not in the data" for c in columns if c not in table.columns]
    faults = {p: pattern_error(p) for p in patterns}
    notes += [f"pattern {p!r} skipped: {fault}" for p, fault in faults.items() if fault]
    for note in notes:
        warnings.warn(note, stacklevel=3)
    return ScanPlan(
        [c for c in columns if c in table.columns], [p for p in patterns if not faults[p]], notes
    )


def with_lineage(table: DataFrame) -> DataFrame:
    """Add the file, where the split of it begins that a task reads, and the row number within the
    file; needs a DataFrame read straight from files."""
    return table.select(
        "*",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_SPLIT),
        F.col("_metadata.row_index").alias(_ROW),
    )


def _pairs(plan: ScanPlan) -> list[tuple[str, str]]:
    return [(c, p) for c in plan.columns for p in plan.patterns]


def _matches(plan: ScanPlan) -> list[Column]:
    """For each pair: whether it matches. Any column type is scanned as text; a null never matches."""
    return [
        F.coalesce(flag, F.lit(False))
        for c in plan.columns
        for flag in match_all(F.col(f"`{c}`").cast("string"), plan.patterns)
    ]


def _iso_text(time: Column, zone: str) -> Column:
    """ISO text; a fraction has six digits and is left out when it is zero."""
    seconds = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(time, ".SSSSSS")
    return F.concat(
        seconds, F.when(fraction == ".000000", "").otherwise(fraction), F.lit(zone)
    )


def message_json(table: DataFrame) -> Column:
    """The whole row as JSON text values; nulls are kept, partition hours keep their zero.

    For rows with their lineage columns.
    """
    fields = []
    for field in table.schema.fields:
        if field.name in (_FILE, _SPLIT, _ROW):
            continue
        text = F.col(f"`{field.name}`").cast("string")
        if field.name == "hour":
            of_folder = F.col(_FILE).contains("/hour=")
            text = F.when(of_folder & (F.length(text) < 2), F.lpad(text, 2, "0")).otherwise(text)
        elif field.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            zone = "+00:00" if field.dataType.typeName() == "timestamp" else ""
            text = _iso_text(F.col(f"`{field.name}`"), zone)
        fields.append(text.alias(field.name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _hits(table: DataFrame, plan: ScanPlan) -> DataFrame:
    """One row per match: file, split of the file, row, number of the pair, value and row as JSON.

    Every pattern is tried once per row, in a projection; the generator then hands out one
    row per pair, of which a filter keeps the matches. That filter cannot move below the
    generator, where it would repeat the matching. Only rows that it keeps are made to JSON.
    """
    flags = _matches(plan)
    flagged = table.select("*", *[flag.alias(f"__m{i}") for i, flag in enumerate(flags)])
    cells = [cell for i in range(len(flags)) for cell in (F.lit(i), F.col(f"__m{i}"))]
    values = F.array(*[F.col(f"`{c}`").cast("string") for c in plan.columns])
    column = F.floor(F.col("__pair") / len(plan.patterns)).cast("int")
    return (
        flagged.select("*", F.stack(F.lit(len(flags)), *cells).alias("__pair", "__matched"))
        .filter("__matched")
        .select(
            F.col(_FILE).alias("file_path"),
            F.col(_SPLIT).alias("split"),
            F.col(_ROW).alias("file_row_index"),
            F.col("__pair").alias("pair"),
            F.get(values, column).alias("column_value"),
            message_json(table).alias("message_json"),
        )
    )


def _count_up(file: Column, split: Column, pair: Column) -> Column:
    """How many earlier rows of the same split of a file have the same pair.

    A split is read in order by one task, so counters that start anew with every split tell it
    without any sorting. Only the three numbers of a match go to Python.
    """

    def number(batches):
        here, counters = None, {}
        for files, splits, pairs in batches:
            at = np.column_stack([files.to_numpy(), splits.to_numpy()])
            kinds = pairs.to_numpy()
            out = np.empty(len(kinds), np.int64)
            # Runs of rows of one split.
            edges = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, len(kinds)] if len(kinds) else []):
                if here != (place := tuple(at[a])):
                    here, counters = place, {}
                for kind in np.unique(kinds[a:b]).tolist():
                    mine = np.flatnonzero(kinds[a:b] == kind)
                    first = counters.get(kind, 0)
                    out[a + mine] = first + np.arange(len(mine))
                    counters[kind] = first + len(mine)
            yield pa.array(out)

    number.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(number, T.LongType())(F.xxhash64(file), split, pair)


def _shifts(hits: DataFrame) -> DataFrame:
    """Matches in the earlier splits of the file, per split and pair, where there are any."""
    earlier = W.partitionBy("file", "pair").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    return (
        hits.groupBy(F.xxhash64("file_path").alias("file"), "split", "pair")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("file", "split", "pair", F.sum("n").over(earlier).alias("shift"))
        .where("shift > 0")
    )


def find_violations(
    table: DataFrame, columns: list[str], patterns: list[str], ordinals: bool = True
) -> DataFrame:
    """One row per match: the six violation columns and ``file_row_index``.

    ``row_index`` numbers the matches of a (file, column, pattern) from 0 in file order. The table
    is scanned once, here, and the matches are stored with their numbers within their split of
    the file; a file of several splits then adds what the splits before hold, which is a
    count over narrow columns of the stored matches. No text is shuffled and no file is ever ordered
    in one task. Without ``ordinals`` the column is the row number in the file and nothing is
    stored: the scan runs when the result is read.
    """
    plan = plan_scan(table, columns, patterns)
    if not plan.columns or not plan.patterns:
        with_row = T.StructType([*VIOLATION_SCHEMA.fields, T.StructField("file_row_index", T.LongType())])
        return table.sparkSession.createDataFrame([], with_row)
    hits = _hits(with_lineage(table), plan)
    if ordinals:
        place = _count_up(F.col("file_path"), F.col("split"), F.col("pair"))
        hits = stored(hits.withColumn("place", place), "scan-hits")
        shifts = stored(_shifts(hits), "scan-shifts")
        # 28 bytes a row; a longer list is joined as Spark sees fit.
        if shifts.count() <= MAX_BROADCAST_SHIFTS:
            shifts = F.broadcast(shifts)
        hits = hits.withColumn("file", F.xxhash64("file_path")).join(shifts, ["file", "split", "pair"], "left")
        index = F.col("place") + F.coalesce(F.col("shift"), F.lit(0))
    else:
        index = F.col("file_row_index")
    pairs = _pairs(plan)
    named = {
        "row_index": index.cast("bigint"),
        "column_name": F.get(F.array(*[F.lit(c) for c, _ in pairs]), F.col("pair")),
        "matched_pattern": F.get(F.array(*[F.lit(p) for _, p in pairs]), F.col("pair")),
    }
    return hits.select(*[named.get(n, F.col(n)).alias(n) for n in VIOLATION_SCHEMA.names], "file_row_index")


def summarise_scan(table: DataFrame, columns: list[str], patterns: list[str]) -> DataFrame:
    """Files, rows and violations of a scan in one aggregation, without listing the matches."""
    plan = plan_scan(table, columns, patterns)
    flags = _matches(plan) if plan.columns and plan.patterns else []
    flagged = table.select(*[flag.alias(f"__m{i}") for i, flag in enumerate(flags)])
    violations = F.lit(0)
    for i in range(len(flags)):
        violations = violations + F.count_if(f"__m{i}")
    return flagged.agg(
        F.lit(len(table._jdf.inputFiles())).cast("bigint").alias("total_files_scanned"),
        F.count(F.lit(1)).alias("total_rows_scanned"),
        violations.cast("bigint").alias("violations_found"),
    )
