"""From observations and yields to the master table and the training dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotseries.operators.cycles import DAY_KEY, REPAIRED_COLUMNS, add_cycles, repaired_days
from lotseries.operators.master import add_season, add_yield_key, build_master, build_master_by_lot
from lotseries.operators.reports import ml_dataset
from lotseries.schema import YIELD_COLUMNS
from lotseries.sources.merge import merge_update
from lotseries.sources.writers import write_table


def report_yields(report: DataFrame, columns: Sequence[str] = YIELD_COLUMNS) -> DataFrame:
    """Yields for ``master_table`` from a parsed report: the given columns, keys renamed."""
    names = {"lote": "lot", "zafra": "season", "cierre": "harvest"}
    chosen = report.select(*columns).withColumnsRenamed(names)
    return chosen.withColumn("lot", F.col("lot").cast("string"))


def master_table(observations: DataFrame, yields: DataFrame, by_lot: bool = False) -> DataFrame:
    """Observations with their yields. ``yields``: ``lot, season`` as reported, ``harvest``, ...

    ``by_lot`` says that the observations lie by lot and no lot has many.
    """
    build = build_master_by_lot if by_lot else build_master
    return build(add_season(observations), add_yield_key(yields))


def training_rows(observations: DataFrame, yields: DataFrame) -> DataFrame:
    """The training dataset as one lazy plan."""
    return ml_dataset(add_cycles(master_table(observations, yields)))


def build_tables(
    spark: SparkSession, observations: DataFrame, yields: DataFrame, master: str, dataset: str
) -> None:
    """Store the joined table, the master with cycles, and the training dataset.

    The joined table is stored before the cycles are derived, because they read it twice.
    """
    joined = f"{master}_joined"
    write_table(master_table(observations, yields), joined)
    write_table(add_cycles(spark.table(joined)), master)
    write_table(ml_dataset(spark.table(master)), dataset)


def repair_table(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Compute age, gap and validity of a stored master again; the partitions that had to be rewritten.

    A second run finds nothing to change and leaves every file as it is.
    """
    days = repaired_days(spark.read.parquet(path))
    return merge_update(spark, path, days, DAY_KEY, REPAIRED_COLUMNS, partition_by)
