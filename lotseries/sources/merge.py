"""Keyed updates of a stored, partitioned table: only partitions with a changed row are rewritten.

An update writes the new content of those partitions beside the table first and marks it as complete; only then
are the partitions replaced. Whatever ends the job on the way, the next update (or ``recover``) finds
either an unmarked copy, which it drops, or a marked one, which it puts in place again. No row is lost.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotseries.sources.stored import file_system, stored

# Names with a leading underscore are no data to Spark's readers.
STAGE = "_merge"
READY = "_merge/_ready"


def _path(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def _same(names: Sequence[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"{prefix}{n}")) for n in names])


def _prefixed(names: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(n).alias(f"{prefix}{n}") for n in names]


def recover(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    """Bring an update that did not come to its end to an end, or take it back."""
    files, stage = file_system(spark, _path(path, STAGE))
    if not files.exists(stage):
        return
    if files.exists(file_system(spark, _path(path, READY))[1]):
        _replace(spark, path, partition_by)
    files.delete(stage, True)


def _mark_ready(spark: SparkSession, path: str, schema: StructType) -> None:
    """The mark holds the table's schema: names of folders alone do not tell the types of partition columns."""
    files, ready = file_system(spark, _path(path, READY))
    out = files.create(ready, True)
    out.write(bytearray(schema.json(), "utf-8"))
    out.close()


def _marked_schema(spark: SparkSession, path: str) -> StructType:
    files, ready = file_system(spark, _path(path, READY))
    stream = files.open(ready)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return StructType.fromJson(json.loads(text))


def _replace(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    """Replace the staged partitions; doing it twice does no harm."""
    staged = spark.read.schema(_marked_schema(spark, path)).parquet(_path(path, f"{STAGE}/data"))
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def _in_partitions(names: list[Row], partition_by: Sequence[str]) -> Column:
    """A condition on partition columns alone, so that Spark lists and opens only these folders."""
    first, rest = partition_by[0], partition_by[1:]
    if not rest:
        values = [row[first] for row in names if row[first] is not None]
        known = F.col(first).isin(values) if values else F.lit(False)
        return known | F.col(first).isNull() if len(values) < len(names) else known
    below: dict = {}
    for row in names:
        below.setdefault(row[first], []).append(row)
    parts = [F.col(first).eqNullSafe(F.lit(value)) & _in_partitions(rows, rest) for value, rows in below.items()]
    return reduce(Column.__or__, parts)


def _rewrite(
    spark: SparkSession, path: str, changed: DataFrame, make: Callable[[DataFrame], DataFrame], partition_by: Sequence[str]
) -> DataFrame:
    """Rewrite the partitions that ``changed`` rows lie in by ``make``; the partitions rewritten."""
    affected = stored(changed.select(*partition_by).distinct())
    names = affected.collect()  # folders of the table at most, which the driver lists anyway
    if not names:
        return affected
    table = spark.read.parquet(path)
    made = make(table.where(_in_partitions(names, partition_by))).select(*table.columns)
    staged = made.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    staged.parquet(_path(path, f"{STAGE}/data"))
    _mark_ready(spark, path, table.schema)
    _replace(spark, path, partition_by)
    files, stage = file_system(spark, _path(path, STAGE))
    files.delete(stage, True)
    return affected


def merge_update(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    partition_by: Sequence[str],
) -> DataFrame:
    """Set ``columns`` of the table's rows from the row of ``updates`` with equal ``keys``; the partitions rewritten.

    ``updates`` has one row per key. Rows without a match keep their values, as do rows with a null key. A partition is
    rewritten only if a value in it changes, so a second run of the same update writes nothing.
    """
    recover(spark, path, partition_by)
    table = spark.read.parquet(path)
    new = stored(updates.select(*_prefixed(keys, "_key_"), *_prefixed(columns, "_new_")))
    match = reduce(Column.__and__, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    seen = table.select(*dict.fromkeys([*keys, *columns, *partition_by])).join(new, match)

    def make(rows: DataFrame) -> DataFrame:
        joined = rows.join(new.withColumn("_matched", F.lit(True)), match, "left")
        return joined.withColumns({c: F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns})

    return _rewrite(spark, path, seen.where(~_same(columns, "_new_")), make, partition_by)


def reset_columns(
    spark: SparkSession, path: str, values: dict[str, Column], partition_by: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Set columns to values, in the rows for which ``where`` holds; the partitions rewritten."""
    recover(spark, path, partition_by)
    chosen = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
    table = spark.read.parquet(path)
    typed = {c: v.cast(table.schema[c].dataType) for c, v in values.items()}
    differs = reduce(Column.__or__, [~F.col(c).eqNullSafe(v) for c, v in typed.items()])

    def make(rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: F.when(chosen, v).otherwise(F.col(c)) for c, v in typed.items()})

    return _rewrite(spark, path, table.where(chosen & differs), make, partition_by)
