"""Intermediate tables of iterative jobs.

Iterations hand their state over through Parquet tables in the shared folder
named by `spark.checkpoint.dir`. That cuts the lineage, gives the next plan
true sizes instead of estimates multiplied at every join, and survives the
loss of executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


class Scratch:
    """A private subfolder of the checkpoint directory."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{_checkpoint_dir(spark).rstrip('/')}/ledgerlens-{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def path(self, name: str) -> str:
        """A fresh path that no earlier table of this scratch has used."""
        self._n += 1
        return f"{self.root}/{self._n:04d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Store the table and return a plan that reads it back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Remove a table of this scratch that no later plan reads."""
        for folder in self._folders(df):
            self._files(folder).delete(folder, True)

    def clear(self, keep: DataFrame | None = None) -> None:
        """Remove all tables of this scratch but the one that the result still reads."""
        kept = {folder.getName() for folder in self._folders(keep)} if keep is not None else set()
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        for entry in self._files(root).listStatus(root):
            if entry.getPath().getName() not in kept:
                self._files(root).delete(entry.getPath(), True)

    def _folders(self, df: DataFrame) -> list:
        """The folder of the table, if it is one of this scratch."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        folders = [path(file).getParent() for file in df.inputFiles()[:1]]
        own = self.root.rsplit("/", 1)[-1]
        return [f for f in folders if f.getParent().getName() == own]

    def _files(self, folder):
        return folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())


def _checkpoint_dir(spark: SparkSession) -> str:
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if configured:
        return configured
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/ledgerlens-scratch"
