"""One listing of a tree of Parquet files, shared by guards, readers and statistics.

Spark lists the tree: folders side by side in a job, once there are more than a few. The paths
come over in one piece; there is no call per file or folder from Python.
"""

from __future__ import annotations

import re
import urllib.parse
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import SparkSession

from fleetlake.sources.storage import Storage

SUFFIX = ".parquet"


def _place(path: str) -> str:
    """The path without scheme and host, which are spelled in several ways."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


@dataclass(frozen=True)
class Tree:
    """The ``.parquet`` files below ``path``: those that Spark's readers take, and ``hidden`` ones,
    whose name or folder begins with "_" or "." (only where asked for)."""

    path: str
    files: list[str] = field(default_factory=list)
    hidden: list[str] = field(default_factory=list)

    def __len__(self) -> int:
        return len(self.files) + len(self.hidden)

    def relative(self) -> list[tuple[str, str]]:
        """Folder, relative to the root, and name of every file."""
        start = len(_place(self.path)) + 1
        parted = (_place(f)[start:].rpartition("/") for f in [*self.files, *self.hidden])
        return [(folder, name) for folder, _, name in parted]

    @cached_property
    def folders(self) -> set[str]:
        """Folders with files, relative to the root."""
        return {folder for folder, _ in self.relative()}

    @cached_property
    def levels(self) -> set[tuple[str, ...]]:
        """The kinds of paths: each part up to its "=", if it has one."""
        return {tuple(p.partition("=")[0] if "=" in p else f"/{p}" for p in f.split("/") if p) for f in self.folders}

    @property
    def partitioned(self) -> bool:
        """Whether Spark's partition discovery reads all of the tree: ``key=value`` folders alone, the
        same keys everywhere."""
        plain = any(p.startswith("/") for level in self.levels for p in level)
        return not self.hidden and not plain and len(self.levels) <= 1

    @property
    def keys(self) -> list[str]:
        return sorted({p for level in self.levels for p in level if not p.startswith("/")})


def files_in(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files below folders that exist, listed side by side by Spark."""
    if not paths:
        return []
    # A schema keeps Spark from opening files: this lists and no more.
    reader = spark.read.schema("listed int").option("pathGlobFilter", f"*{SUFFIX}").option("recursiveFileLookup", "true")
    return sorted(map(urllib.parse.unquote, Storage(spark).texts(reader.parquet(*paths)._jdf.inputFiles())))


def list_tree(spark: SparkSession, path: str, hidden: bool = False) -> Tree:
    """The files below ``path``; none where it does not exist."""
    storage = Storage(spark)
    root = storage.qualified(path)
    if not storage.exists(path):
        return Tree(root)
    return Tree(root, files_in(spark, [path]), storage.hidden_files(path, SUFFIX) if hidden else [])
