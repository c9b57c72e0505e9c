"""Readers. All of them leave column pruning and filters to the file source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotseries.schema import INDICES, OBSERVATION_COLUMNS, rename_source_columns

OBSERVATION_SCHEMA = ", ".join(
    f"{c} {'date' if c == 'obs_date' else 'string' if c in ('lot_id', 'image_id') else 'double'}"
    for c in OBSERVATION_COLUMNS
)


def _index_means(df: DataFrame, *more: str) -> DataFrame:
    named = rename_source_columns(df)
    return named.select(
        "lot_id",
        F.to_date("obs_date").alias("obs_date"),
        *more,
        *[f"{i}_mean" for i in INDICES],
        F.col("_metadata.file_path").alias("_path"),
    )


def folder_year(path: Column) -> Column:
    """Year folder directly above a file."""
    return F.regexp_extract(path, r"/(?:year=)?(\d{4})/[^/]*$", 1).try_cast("int")


def read_reference(spark: SparkSession, root: str, years: Sequence[int] | None = None) -> DataFrame:
    """Index means of the reference source; ``year`` is that of the folder, not of the date.

    Files lie at ``root/{year}/*.parquet`` or ``root/year={year}/*.parquet``; with ``years`` other
    folders are not listed.
    """
    folders = [f"{root}/{{{y},year={y}}}" for y in years] if years else [f"{root}/*"]
    df = _index_means(spark.read.parquet(*[f"{folder}/*.parquet" for folder in folders]))
    return df.withColumn("year", folder_year(F.col("_path"))).drop("_path")


def read_scene_indices(spark: SparkSession, root: str) -> DataFrame:
    """Index means of the scene source; ``year`` is that of the date."""
    df = _index_means(spark.read.parquet(f"{root}/*/*.parquet"), "image_id")
    return df.withColumn("year", F.year("obs_date")).drop("_path")


def read_observations_csv(spark: SparkSession, path: str) -> DataFrame:
    """Corrected observations from CSV: the columns of the observation table, dates parsed.

    The header decides which file column is which, so extra columns and another
    order do no harm; there is no inference pass over the data.
    """
    raw = rename_source_columns(spark.read.csv(path, header=True))
    typed = {
        c: F.col(c).try_cast("double")
        for c in OBSERVATION_COLUMNS
        if c not in ("lot_id", "image_id", "obs_date")
    }
    day = F.to_date(F.substring("obs_date", 1, 10))
    return raw.withColumns({**typed, "obs_date": day}).select(*OBSERVATION_COLUMNS)


def read_factors(spark: SparkSession, path: str, factor_set: str = "validation_1") -> DataFrame:
    """Correction factors of one set as rows ``index, slope, intercept``."""
    line = "struct<slope: double, intercept: double>"
    schema = f"{factor_set} struct<{', '.join(f'{i}: {line}' for i in INDICES)}>"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    rows = [
        F.struct(F.lit(i).alias("index"), F.col(f"{factor_set}.{i}.slope"), F.col(f"{factor_set}.{i}.intercept"))
        for i in INDICES
    ]
    return raw.select(F.inline(F.array(*rows))).toDF("index", "slope", "intercept")


def factor_dict(factors: DataFrame) -> dict[str, dict[str, float]]:
    """Factors as a dict for ``apply_correction``: one row per index comes to the driver."""
    return {
        r["index"]: {"slope": r["slope"], "intercept": r["intercept"]} for r in factors.collect()
    }


def read_lots(spark: SparkSession, path: str, lot_column: str = "lot_id") -> DataFrame:
    """Lot polygons from Parquet: ``polygon_id, lot_id, ring``.

    Only if the lot column is missing from the table does the polygon id stand
    in for it. All coordinates must be in one reference system.
    """
    lots = spark.read.parquet(path)
    if lot_column not in lots.columns:
        return lots.withColumn("lot_id", F.col("polygon_id").cast("string"))
    return lots.withColumnRenamed(lot_column, "lot_id")


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Pixel table ``scene_id, band, row, col, value``, one Parquet folder per scene."""
    return spark.read.parquet(path).select("scene_id", "band", "row", "col", "value")


def read_manifest(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Files below a folder: path and size. File contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    )
    return files.select("path", "length").where(F.col("path").endswith(suffix))


def read_query(spark: SparkSession, sql: str, **parameters: object) -> DataFrame:
    """Result of a SQL text with named parameters; lists become arrays."""
    values = {
        k: F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else v
        for k, v in parameters.items()
    }
    return spark.sql(sql, args=values)
