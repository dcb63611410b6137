"""Intermediate tables in the folder that the cluster shares.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir`` of the session and
reading it back, so that a lost executor costs at most the running step. Where the
setting is absent, one process on one machine (``local[...]``, as in tests) uses a temporary folder;
any cluster refuses, as its executors would write to disks that the others don't see.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Workspace:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
        if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        root = root or tempfile.mkdtemp(prefix="millrace-")
        self.root = f"{root.rstrip('/')}/millrace-{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.saved: list[DataFrame] = []

    def path(self, name: str) -> str:
        """A new place in this workspace."""
        self.n += 1
        return f"{self.root}/{self.n:02d}-{name}"

    def save(self, df: DataFrame, name: str = "step") -> DataFrame:
        """df, computed once."""
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._millrace_path = path
        self.saved.append(out)
        return out

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        """df, computed once, after which all tables saved before are deleted."""
        before, self.saved = self.saved, []
        out = self.save(df, name)
        self.drop(*before)
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Deletes saved tables that nothing will read any more."""
        jvm = self.spark.sparkContext._jvm
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._millrace_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
