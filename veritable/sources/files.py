"""Files and folders at any Spark path, by way of Hadoop's file systems."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(part.strip("/") for part in parts[1:])])


class Folder:
    """A folder; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        # The session's own settings count as well, not those of the context alone.
        settings = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._at(path).getFileSystem(settings)

    def _full(self, name: str) -> Any:
        return self._at(join(self.path, name)) if name else self._at(self.path)

    def has(self, name: str = "") -> bool:
        return self._fs.exists(self._full(name))

    def files(self, pattern: str) -> list[str]:
        """Names that match a glob pattern, in order; none if the folder is missing."""
        found = self._fs.globStatus(self._full(pattern)) or []
        root = self._fs.makeQualified(self._at(self.path)).toString()
        return sorted(status.getPath().toString().removeprefix(root).lstrip("/") for status in found)

    def move(self, name: str, to: str) -> None:
        """One rename. On object stores it copies the file and shows it when it is whole."""
        target = self._full(to)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._full(name), target):
            raise OSError(f"Could not move {name!r} to {to!r} in {self.path!r}")

    def remove(self, name: str = "") -> None:
        """Remove a file or folder with all it holds; nothing happens if it is missing."""
        self._fs.delete(self._full(name), True)
