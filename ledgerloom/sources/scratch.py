"""Staged tables: how a plan cuts its lineage without relying on executors.

A result that several later steps need is written once as Parquet to the
shared folder named by ``spark.checkpoint.dir``; losing executors then costs a
re-read, not a re-computation, and readers still prune columns.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPRESSION = "zstd"  # of tables, and of rows that are being regrouped
TASK_BYTES = 16 << 20  # compressed columns of a task: some half a million to a million rows


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    In one local process, where nothing else shares files, an unset folder is
    set to a temporary one; anywhere else it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


class Scratch:
    """One run's private folder below the shared one."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(
        self,
        df: DataFrame,
        name: str,
        cluster_by: str | None = None,
        directory_by: str | None = None,
    ) -> DataFrame:
        """Write ``df`` once and return the table that was written.

        ``cluster_by`` regroups the rows by that column on the way (AQE cuts
        large groups into several tasks), so that a later write by the same
        column needs no shuffle.  ``directory_by`` keeps a column's few values
        in directories, so that readers of one see only its bytes.
        """
        path = self.path(f"{name}-{uuid.uuid4().hex}")
        if cluster_by:
            df.hint("rebalance", F.col(cluster_by)).write.partitionBy(cluster_by).parquet(path)
        elif directory_by:
            df.write.partitionBy(directory_by).parquet(path)
        else:
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def regroup(self, df: DataFrame, name: str, by: str) -> DataFrame:
        """Write ``df`` once and return the table that was written, ``by`` column: a
        task holds rows of one value, or of few neighbours, and a large value's are cut
        into several tasks.

        Like ``stage`` with ``cluster_by``, but through files alone: every task writes
        a file per value, which are then read together.  Compressed columns take a
        fraction of the disk that shuffled rows do, and no shuffle files outlive them.
        Meant for a column of few values, such as snapshots.
        """
        path = self.path(f"{name}-{uuid.uuid4().hex}")
        df.write.option("compression", COMPRESSION).partitionBy(by).parquet(path)
        folder, files = self._folder(path)
        stored = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith(f"{by}=")]
        stored.sort(key=str)
        tasks = sum(files.getContentSummary(at).getLength() // TASK_BYTES + 1 for at in stored)
        read = self.spark.read.schema(df.schema).option("basePath", path)
        # the parts are put together before the rows are taken from their columns, or each
        # would have code of its own, which fills the driver's memory
        parts = [read.parquet(str(at)) for at in stored] or [read.parquet(path)]
        return reduce(DataFrame.unionAll, parts).coalesce(max(tasks, 1)).select(*df.columns)

    def _folder(self, path: str):
        """A path and its file system."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def remove(self, name: str) -> None:
        """Delete one path of the run, once nothing reads from it any more."""
        folder, files = self._folder(self.path(name))
        files.delete(folder, True)

    def discard(self) -> None:
        """Delete the folder; call only once nothing reads from it any more."""
        folder, files = self._folder(self.root)
        files.delete(folder, True)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_exc) -> None:
        self.discard()
