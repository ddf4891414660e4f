"""Commit records of versioned state: small files in the shared folder that appear at once and name what a version consists of."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class CommitLog:
    """Records by version number under ``<base>/commits``. Data files count only once a record names them."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self.hadoop.Path("/".join((self.base, *parts)))

    def versions(self) -> list[int]:
        """The committed versions, oldest first."""
        at = self.path("commits")
        return sorted(int(s.getPath().getName()) for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def record(self, version: int) -> dict:
        stream = self.fs.open(self.path("commits", str(version)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, version: int, record: dict) -> None:
        """The record appears under its name at once, in place of an older one of the same version."""
        pending, final = self.path("pending", str(version)), self.path("commits", str(version))
        out = self.fs.create(pending, True)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        self.fs.mkdirs(final.getParent())
        rename = self.hadoop.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self.fs.makeQualified(pending), self.fs.makeQualified(final), how)

    def keep_only(self, kind: str, names: set[str]) -> None:
        """Deletes the folders of a kind that no kept record names."""
        at = self.path(kind)
        for s in self.fs.listStatus(at) if self.fs.exists(at) else []:
            if f"{kind}/{s.getPath().getName()}" not in names:
                self.fs.delete(s.getPath(), True)
