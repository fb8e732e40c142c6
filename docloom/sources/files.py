"""Small files and folders wherever Spark reads and writes, by Hadoop's file systems on the driver."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.configuration, self.root = spark._jvm, spark._jsc.hadoopConfiguration(), root.rstrip("/")

    def _at(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(self.configuration), path

    def exists(self, name: str) -> bool:
        system, path = self._at(name)
        return system.exists(path)

    def names(self, name: str = "") -> list[str]:
        """What a folder holds, sorted; nothing for one that isn't there."""
        system, path = self._at(name)
        return sorted(x.getPath().getName() for x in system.listStatus(path)) if system.exists(path) else []

    def sizes(self, name: str) -> dict[str, int]:
        """Bytes of each file of a folder."""
        system, path = self._at(name)
        return {x.getPath().getName(): x.getLen() for x in system.listStatus(path)} if system.exists(path) else {}

    def size(self, name: str) -> int:
        """Bytes of a folder with all that it holds."""
        system, path = self._at(name)
        return system.getContentSummary(path).getLength() if system.exists(path) else 0

    def delete(self, name: str) -> None:
        system, path = self._at(name)
        system.delete(path, True)

    def rename(self, old: str, new: str) -> None:
        system, source = self._at(old)
        target = self._at(new)[1]
        system.mkdirs(target.getParent())
        if not system.rename(source, target):
            raise OSError(f"{source} can't be renamed to {target}")

    def read(self, name: str) -> dict | None:
        """A JSON file; None if it is missing."""
        system, path = self._at(name)
        if not system.exists(path):
            return None
        stream = system.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, name: str, value: dict) -> None:
        """A JSON file, seen whole or not at all: written beside and renamed."""
        system, path = self._at(name)
        beside = self.jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.new")
        stream = system.create(beside, True)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        if system.exists(path):
            system.delete(path, False)
        system.rename(beside, path)
