"""Small file operations through Hadoop's file system API, so they work wherever Spark writes."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """A folder on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def read_json(self, name: str):
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_json(self, name: str, value) -> None:
        """Complete or not there at all: written beside, then renamed."""
        aside = self._at(f"{name}.writing")
        out = self._fs.create(aside, True)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()
        if self._fs.exists(self._at(name)):
            self._fs.delete(self._at(name), False)
        if not self._fs.rename(aside, self._at(name)):
            raise OSError(f"cannot write {self.path}/{name}")

    def folders(self) -> list[str]:
        """Names of the folders directly below, without hidden ones."""
        found = (x for x in self._fs.listStatus(self._at()) if x.isDirectory())
        return sorted(n for n in (x.getPath().getName() for x in found) if not n.startswith(("_", ".")))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
