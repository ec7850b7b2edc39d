"""Small file operations on the folders Spark writes to."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """A folder on any file system the session can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        hadoop = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(hadoop)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def read_json(self, name: str):
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(
                self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            )
        finally:
            stream.close()

    def write_json(self, name: str, value, new: bool = False) -> None:
        """Write beside, then rename over: readers see the old or the new text.

        With ``new``, a file of that name is an error.
        """
        if new and self.exists(name):
            raise FileExistsError(f"{name} in {self.path} is already there: another writer came first")
        beside = self._at(f".{name}.new")
        stream = self._fs.create(beside, True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        target = self._at(name)
        if self._fs.exists(target):
            self._fs.delete(target, False)
        if not self._fs.rename(beside, target):
            raise OSError(f"cannot publish {name} in {self.path}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
