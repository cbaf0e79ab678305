"""Replacing a set of tables as a whole: staged versions and a manifest that names the valid one.

A version is written under a folder of its own; nothing reads it before its manifest is there.
Manifests are numbered, the highest complete one is valid. A write that dies half-way leaves
the former version as it was, and readers that began with it keep its files until it is retired.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


class Versions:
    """The versions of the tables under one folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, location: str) -> None:
        self.spark, self.location = spark, location.rstrip("/")

    def _path(self, *parts: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.location, *parts]))
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def stage(self) -> str:
        """The name of a new version; its tables go to :meth:`folder` of it."""
        return uuid.uuid4().hex

    def folder(self, version: str, table: str) -> str:
        return f"{self.location}/versions/{version}/{table}"

    def _read(self, number: int) -> dict | None:
        p, fs = self._path("manifests", f"{number:08d}.json")
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        try:
            return json.loads(text) | {"number": number}
        except ValueError:
            return None         # its writer died while writing it

    def numbers(self) -> list[int]:
        p, fs = self._path("manifests")
        if not fs.exists(p):
            return []
        names = [str(s.getPath().getName()) for s in fs.listStatus(p)]
        return sorted(int(n[:8]) for n in names if n.endswith(".json") and n[:8].isdigit())

    def manifests(self) -> list[dict]:
        """All complete manifests, the valid one last."""
        return [m for m in map(self._read, self.numbers()) if m]

    def current(self) -> dict | None:
        """The valid manifest: version, tables and number; None before the first commit."""
        for number in reversed(self.numbers()):
            if manifest := self._read(number):
                return manifest
        return None

    def commit(self, version: str, tables: list[str]) -> dict:
        """Makes ``version`` valid: one new file. Of writers that commit at once each gets a number of
        its own, as the file is created only if it is not there; the last one is valid."""
        text = json.dumps({"version": version, "tables": sorted(tables)})
        number = max(self.numbers(), default=0)
        while True:
            number += 1
            p, fs = self._path("manifests", f"{number:08d}.json")
            if fs.exists(p):
                continue
            try:
                stream = fs.create(p, False)
            except Exception as e:  # noqa: BLE001 - py4j wraps the file system's error
                if fs.exists(p):
                    continue
                raise PySparkException(f"cannot write {p}") from e
            stream.write(text.encode())
            stream.close()
            return json.loads(text) | {"number": number}

    def read(self, table: str, version: str | None = None) -> DataFrame:
        """A table of the valid version (or of the named one)."""
        if version is None:
            manifest = self.current()
            if not manifest or table not in manifest["tables"]:
                raise FileNotFoundError(f"{self.location}: no version with {table}")
            version = manifest["version"]
        return self.spark.read.parquet(self.folder(version, table))

    def retire(self, keep: int = 2) -> list[str]:
        """Deletes the manifests and folders of all but the last ``keep`` committed versions."""
        old = self.manifests()[:-max(1, keep)]
        for m in old:
            for parts in (("manifests", f"{m['number']:08d}.json"), ("versions", m["version"])):
                p, fs = self._path(*parts)
                fs.delete(p, True)
        return [m["version"] for m in old]
