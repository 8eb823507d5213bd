"""Session helpers: shared work folder, written tables, checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its row count was checked against this bound.
BROADCAST_ROWS = 500_000
# Stored text takes a third less room than with Spark's default, at about the same time.
COMPRESSION = "zstd"


def work_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Where the session names none, the folder set by ``setCheckpointDir`` is
    taken. Only in a local run without either, a temporary folder is made and
    remembered in the session; on a cluster that is an error, for executors do
    not see each other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("docsearch.work.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        root = tempfile.mkdtemp(prefix="docsearch-")
        spark.conf.set("docsearch.work.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors and keeps column
    pruning and filter pushdown for the readers.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when the given upper bound of its rows is small enough."""
    return F.broadcast(df) if rows <= bound else df


def spread(df: DataFrame) -> DataFrame:
    """Spread an input that comes in fewer splits than there are cores.

    A table with enough row groups is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
