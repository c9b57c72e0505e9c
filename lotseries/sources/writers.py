"""Writers. Each overwrites only what it produces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JDBC_BATCH = 10_000


def write_indices(df: DataFrame, path: str, by: Sequence[str] = ("year",)) -> None:
    """Parquet under ``path/year=...``; a re-run replaces only the partitions it writes.

    The rebalance hint gathers the rows of a partition value and splits a large
    one over several tasks, so that no value is a single task or thousands of files.
    """
    if "year" in by and "year" not in df.columns:
        df = df.withColumn("year", F.year("obs_date"))
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header in every file; the files are gzipped, which readers undo by themselves."""
    writer = df.write.mode("overwrite").option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path, header=True, compression="gzip")


def write_table(df: DataFrame, name: str) -> None:
    """Replace a table by the result of a query."""
    df.write.mode("overwrite").saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table, in batches."""
    writer = df.write.format("jdbc").mode("overwrite").option("batchsize", JDBC_BATCH)
    writer.options(url=url, dbtable=table, **options).save()


def write_factors(final: DataFrame, validation: DataFrame, path: str) -> None:
    """Correction factors of both sets as one JSON document."""

    def packed(df: DataFrame, name: str) -> DataFrame:
        line = F.struct("slope", "intercept")
        # one row per index
        lines = F.map_from_entries(F.collect_list(F.struct("index", line)))
        return df.agg(lines.alias(name))

    both = packed(final, "final").select(
        "final", packed(validation, "validation_1").scalar().alias("validation_1")
    )
    both.coalesce(1).write.mode("overwrite").json(path)
