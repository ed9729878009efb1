"""Path checks and housekeeping through the Hadoop file system API, for any storage scheme."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._paths = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        hadoop_path = self._paths.Path(path)
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def exists(self, path: str) -> bool:
        fs, hadoop_path = self._open(path)
        return fs.exists(hadoop_path)

    def qualified(self, path: str) -> str:
        """The path with scheme and authority, the same however it was spelled."""
        fs, hadoop_path = self._open(path)
        return fs.makeQualified(hadoop_path).toString().rstrip("/")

    def home(self) -> str:
        """The user's directory on the default file system."""
        return self._paths.FileSystem.get(self._conf).getHomeDirectory().toString()

    def texts(self, array) -> list[str]:
        """The elements of a Java array of strings, brought over in one piece."""
        text = self._jvm.org.apache.hadoop.util.StringUtils.join("\n", array)
        return text.split("\n") if text else []

    def hidden_files(self, path: str, suffix: str) -> list[str]:
        """Full paths of the files below ``path`` that end so and that Spark's listing passes over,
        because their name or a folder's begins with "_" or ".".

        The file system lists the tree and hands it over in one piece.
        """
        root = self.qualified(path)
        fs, hadoop_path = self._open(path)
        listed = self._jvm.org.apache.hadoop.util.functional.RemoteIterators.toList(fs.listFiles(hadoop_path, True))
        found = []
        for file in re.findall(r"\{path=(.*?); isDirectory=false; length=", listed.toString(), re.S):
            parts = file.removeprefix(root).strip("/").split("/")
            if file.endswith(suffix) and any(p[0] in "_." and "=" not in p for p in parts if p):
                found.append(file)
        return sorted(found)

    def names(self, path: str, suffix: str = "") -> list[str]:
        """Names directly under a directory; empty when it does not exist."""
        fs, hadoop_path = self._open(path)
        if not fs.exists(hadoop_path):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(hadoop_path)]
        return sorted(n for n in found if n.endswith(suffix))

    def has_file(self, path: str, suffix: str) -> bool:
        """Whether any file below ``path`` ends so; stops at the first one."""
        fs, hadoop_path = self._open(path)
        if not fs.exists(hadoop_path):
            return False
        walker = fs.listFiles(hadoop_path, True)
        while walker.hasNext():
            if walker.next().getPath().getName().endswith(suffix):
                return True
        return False

    def read_text(self, path: str) -> str:
        """The whole of a small text file."""
        fs, hadoop_path = self._open(path)
        stream = fs.open(hadoop_path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small text file; it appears whole or not at all."""
        fs, hadoop_path = self._open(path)
        _, beside = self._open(f"{path}.new")
        stream = fs.create(beside, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        fs.delete(hadoop_path, False)
        if not fs.rename(beside, hadoop_path):
            raise OSError(f"cannot rename {path}.new")

    def delete(self, path: str) -> None:
        fs, hadoop_path = self._open(path)
        fs.delete(hadoop_path, True)
