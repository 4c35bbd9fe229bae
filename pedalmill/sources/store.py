"""Versioned tables in folders: publish whole versions, read the current one, go back to an earlier one."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class TableStore:
    """Tables under one folder of any file system that Spark knows.

    A version is written beside the others and counts only once the pointer file names it, which is
    replaced in one step; so a failed or dry run leaves readers as they were.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(self.folder))

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def _folders(self, path: str) -> list[str]:
        at = self._path(path)
        found = self._fs.listStatus(at) if self._fs.exists(at) else []
        return sorted(s.getPath().getName() for s in found if s.isDirectory() and not s.getPath().getName().startswith("_"))

    def current(self, name: str) -> str | None:
        at = self._path(self.folder, name, "_current")
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        return self.current(name) is not None

    def versions(self, name: str) -> list[str]:
        """Oldest first."""
        return self._folders(f"{self.folder}/{name}")

    def read(self, name: str, version: str | None = None) -> DataFrame:
        version = version or self.current(name)
        if version is None:
            raise KeyError(f"no table {name}")
        return self.spark.read.parquet(f"{self.folder}/{name}/{version}")

    def publish(self, name: str, df: DataFrame, check: Callable[[DataFrame], None] | None = None, dry_run: bool = False, partition_by: tuple[str, ...] = ()) -> str:
        """Write ``df`` as a new version, ``check`` it (it raises to refuse), then make it the current one."""
        version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.folder}/{name}/{version}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        try:
            if check:
                check(self.spark.read.parquet(path))
        except Exception:
            self._fs.delete(self._path(path), True)
            raise
        if dry_run:
            self._fs.delete(self._path(path), True)
        else:
            self._point(name, version)
        return version

    def _point(self, name: str, version: str) -> None:
        part = self._path(self.folder, name, f"_{uuid.uuid4().hex}")
        stream = self._fs.create(part, True)
        try:
            stream.write(bytearray(version.encode()))
        finally:
            stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        rename = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()
        how = self.spark.sparkContext._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        how[0] = next(r for r in rename if r.name() == "OVERWRITE")
        files.rename(self._fs.makeQualified(part), self._fs.makeQualified(self._path(self.folder, name, "_current")), how)

    def revert(self, name: str, version: str | None = None) -> str:
        """Make ``version``, or the one before the current, the current one."""
        known = self.versions(name)
        if version is None:
            older = [v for v in known if v < (self.current(name) or "")]
            if not older:
                raise KeyError(f"{name} has no earlier version")
            version = older[-1]
        if version not in known:
            raise KeyError(f"{name} has no version {version}")
        self._point(name, version)
        return version

    def snapshot(self) -> dict[str, str]:
        """Current versions of all tables, to go back to by restore."""
        return {n: v for n in self._folders(self.folder) if (v := self.current(n))}

    def restore(self, snapshot: dict[str, str]) -> None:
        for name, version in snapshot.items():
            self.revert(name, version)
