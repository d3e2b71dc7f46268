"""A small replaceable record in a shared folder, published in one step.

Each version is a JSON file of its own, written beside its place and renamed into it.  A
rename onto a version that is there already fails, so of two writers that start from one version one
is told.  Only the last two versions are kept.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tallyspan.sources.files import _hadoop_path, delete_path, path_exists

KEPT_VERSIONS = 2


class Conflict(RuntimeError):
    """Another writer has published the version first."""


@dataclass(frozen=True)
class Pointer:
    root: str

    def _versions(self, spark: SparkSession) -> list[int]:
        if not path_exists(spark, self.root):
            return []
        fs, folder = _hadoop_path(spark, self.root)
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _file(self, version: int) -> str:
        return f"{self.root}/{version:012d}.json"

    def read(self, spark: SparkSession) -> tuple[int, dict]:
        """The latest version and its content; (0, {}) before the first one."""
        versions = self._versions(spark)
        if not versions:
            return 0, {}
        fs, file = _hadoop_path(spark, self._file(versions[-1]))
        stream = fs.open(file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return versions[-1], json.loads(text)

    def publish(self, spark: SparkSession, version: int, content: dict) -> None:
        """Makes ``content`` the version after ``version``."""
        fs, draft = _hadoop_path(spark, f"{self.root}/.draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        stream.close()
        _, final = _hadoop_path(spark, self._file(version + 1))
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise Conflict(f"version {version + 1} of {self.root} is there already")
        for old in self._versions(spark)[:-KEPT_VERSIONS]:
            delete_path(spark, self._file(old))
