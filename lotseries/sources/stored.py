"""Results kept in the shared folder of the cluster, for plans that read them more than once."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORK_DIR = "spark.lotseries.work.dir"
CHECKPOINT_DIR = "spark.checkpoint.dir"

# In the metadata of a column: its place among the keys of the buckets.
BUCKET_KEY = "lotseries.bucket_key"

_written: set[str] = set()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="lotseries-")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session (``WORK_DIR``, else ``CHECKPOINT_DIR``).

    Without either, a temporary folder in local mode; on a cluster an error, as
    its executors share no machine-local folder.
    """
    named = spark.conf.get(WORK_DIR, None) or spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError(f"set {WORK_DIR} or {CHECKPOINT_DIR} to a folder that all executors share")
    return _own_folder()


def file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def fresh_path(spark: SparkSession) -> str:
    """A new path in the shared folder; it goes with ``drop_stored`` or when Spark ends."""
    path = f"{shared_folder(spark)}/lotseries/{uuid.uuid4().hex}"
    files, where = file_system(spark, path)
    files.deleteOnExit(where)
    _written.add(path)
    return path


def in_buckets(df: DataFrame, *keys: str) -> DataFrame:
    """The rows marked to be stored in buckets by ``keys``; equal keys should have few rows, as they share a file.

    What then groups by the keys, or by more columns, and what joins on just the keys needs no shuffle.
    """
    return df.withColumns({k: F.col(k).alias(k, metadata={BUCKET_KEY: i}) for i, k in enumerate(keys)})


def _bucketed(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"lotseries_{path[-32:]}"
    plain = df.withColumns({k: F.col(k).alias(k, metadata={}) for k in keys})
    # one task per bucket, so one file; rows that lie so already are not shuffled again
    writer = plain.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    writer.format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write a result as Parquet and read it back.

    It survives lost executors, cuts the lineage, and later readers still
    prune columns and push filters down. Rows marked by ``in_buckets`` are kept in buckets.
    """
    spark = df.sparkSession
    path = fresh_path(spark)
    places = {f.metadata[BUCKET_KEY]: f.name for f in df.schema if BUCKET_KEY in f.metadata}
    if places:
        return _bucketed(df, [places[i] for i in sorted(places)], path)
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        for path in {file[: file.rindex("/lotseries/") + 43] for file in table.inputFiles() if "/lotseries/" in file}:
            _delete(table.sparkSession, path)


def drop_stored(spark: SparkSession) -> None:
    """Delete all that ``stored`` has written; call it once the results have been used."""
    for path in list(_written):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)
    spark.sql(f"DROP TABLE IF EXISTS lotseries_{path[-32:]}")
    _written.difference_update([p for p in _written if p.endswith(path[-32:])])
