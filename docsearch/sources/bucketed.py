"""Bucketed Parquet tables in folders of their own, and small tables of JSON rows."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from docsearch.runtime import COMPRESSION


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON folder; none where there is no folder yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def append_json(spark: SparkSession, path: str, schema: str, rows: Sequence[tuple]) -> None:
    """Add rows in one file, so that all of them become visible at once."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").json(path)


def latest(rows: DataFrame, by: str) -> Row | None:
    return rows.orderBy(rows[by].desc()).first()


def write_bucketed(
    df: DataFrame, path: str, n_buckets: int, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Write one file for each bucket of ``keys``, sorted by ``order``.

    Rows that are not dealt by the keys yet are dealt here, by one shuffle.
    """
    spark, name = df.sparkSession, f"docsearch_{uuid.uuid4().hex}"
    (
        df.sortWithinPartitions(*order).write.bucketBy(n_buckets, *keys).sortBy(*order)
        .option("path", path).option("compression", COMPRESSION).saveAsTable(name)
    )
    # Only the name goes; the files of a table with a path of its own stay.
    spark.sql(f"DROP TABLE {name}")


def read_bucketed(
    spark: SparkSession, folders: Sequence[str], schema: str, n_buckets: int, keys: Sequence[str]
) -> DataFrame:
    """The rows of all folders as one bucketed table: bucket k of every folder is one task.

    The session's catalog gets one name for each set of folders.
    """
    name = "docsearch_" + hashlib.sha256("\n".join(folders).encode()).hexdigest()[:32]
    if not spark.catalog.tableExists(name):
        clustered = f"CLUSTERED BY ({', '.join(keys)}) INTO {n_buckets} BUCKETS"
        if len(folders) == 1:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {clustered} "
                      f"LOCATION '{folders[0]}'")
        else:
            parent = folders[0].rsplit("/", 1)[0] if folders else None
            at = f"LOCATION '{parent}'" if parent else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, segment string) USING parquet "
                      f"PARTITIONED BY (segment) {clustered} {at}")
            for folder in folders:
                segment = folder.rsplit("segment=", 1)[1]
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (segment='{segment}') "
                          f"LOCATION '{folder}'")
    return spark.table(name).select(*[c.split()[0] for c in schema.split(", ")])
