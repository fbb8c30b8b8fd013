"""Versioned model tables for streaming learners.

Every micro-batch writes the tables of its own version and then one commit row.  A replayed micro-batch overwrites its
version, and loads the newest committed version before it, so a restart gives the same models as an uninterrupted run.
Only the newest versions are kept: Spark repeats no micro-batch but the last one.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ModelStore:
    """``keep`` is the number of committed versions that stay; a replay needs the version before the last one."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        if keep < 2:
            raise ValueError(f"keep: required 2 or more but found {keep}")
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def write(self, name: str, version: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/version={version}")

    def read(self, name: str, version: int, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/version={version}")

    def commit(self, version: int, meta: dict) -> None:
        row = self.spark.createDataFrame([(json.dumps(meta),)], "meta string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/version={version}")
        self._expire(version)

    def _expire(self, newest: int) -> None:
        """Remove the tables of versions older than the newest ``keep`` ones; their commit goes last."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())

        def children(folder) -> dict:
            return {f.getPath().getName(): f.getPath() for f in files.listStatus(folder) if f.isDirectory()}

        tables = children(root)
        commits = children(tables.pop("commits"))
        done = sorted(v for v in (int(n.split("=")[1]) for n in commits if "=" in n) if v <= newest)
        if len(done) <= self.keep:
            return
        oldest = done[-self.keep]
        for folder in tables.values():
            for name, at in children(folder).items():
                if "=" in name and int(name.split("=")[1]) < oldest:
                    files.delete(at, True)
        for v in done[: -self.keep]:
            files.delete(commits[f"version={v}"], True)

    def latest_before(self, version: int | None = None) -> tuple[int, dict] | None:
        """Newest committed version (below ``version``) and its metadata."""
        try:
            commits = self.spark.read.schema("meta string, version int").parquet(f"{self.path}/commits")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        if version is not None:
            commits = commits.filter(F.col("version") < version)
        row = commits.orderBy(F.col("version").desc()).first()
        return None if row is None else (row["version"], json.loads(row["meta"]))
