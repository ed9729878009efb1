"""Readers of the Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.schemas import BRONZE_TABLE_SCHEMA
from fleetlake.sources.listing import SUFFIX, Tree, list_tree


def has_parquet(spark: SparkSession, path: str) -> bool:
    return bool(list_tree(spark, path).files)


def read_tree(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False, tree: Tree | None = None
) -> DataFrame:
    """Every ``.parquet`` file below ``path``, however the folders are nested.

    A tree of ``key=value`` folders alone is read with Spark's partition discovery, so filters
    on the keys prune folders. Where plain folders occur, Spark's discovery would pass over
    files; such a tree is read file by file, and the keys come from the paths as text. So is one
    with hidden files. ``tree`` is the listing, where the caller has it.
    """
    reader = spark.read.option("pathGlobFilter", f"*{SUFFIX}")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", str(merge).lower())
    tree = list_tree(spark, path) if tree is None else tree
    if tree.partitioned:
        return reader.parquet(path)
    table = reader.option("recursiveFileLookup", "true").parquet(path, *tree.hidden)
    types = {f.name: f.dataType for f in table.schema.fields}
    for key in tree.keys:
        at = F.regexp_extract(F.col("_metadata.file_path"), f"/\\Q{key}\\E=([^/]*)/", 1)
        value = F.when((at != "") & (at != "__HIVE_DEFAULT_PARTITION__"), F.url_decode(at))
        value = value.try_cast(types[key]) if key in types else value
        table = table.withColumn(key, F.coalesce(F.col(f"`{key}`"), value) if key in types else value)
    return table


def read_bronze(
    spark: SparkSession, path: str, schema: T.StructType | None = BRONZE_TABLE_SCHEMA, tree: Tree | None = None
) -> DataFrame:
    """All Bronze files, with the declared schema; ``schema=None`` takes it from the files."""
    return read_tree(spark, path, schema, tree=tree)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver with its ``date`` and ``hour`` columns; an empty table is an error."""
    tree = list_tree(spark, path)
    silver = read_tree(spark, path, tree=tree) if tree.files else None
    if silver is None or silver.isEmpty():
        raise FileNotFoundError(f"No Silver data found in {path}")
    return silver


def read_for_scan(
    spark: SparkSession, path: str, schema: T.StructType | None = None, tree: Tree | None = None
) -> DataFrame | None:
    """Every Parquet file below ``path``, hidden ones too, columns merged over the files; None without files.

    Merging reads all footers, in a Spark job; pass ``schema`` where it is known.
    """
    tree = list_tree(spark, path, hidden=True) if tree is None else tree
    return read_tree(spark, path, schema, merge=True, tree=tree) if len(tree) else None
