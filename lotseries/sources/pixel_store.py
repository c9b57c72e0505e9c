"""Pixels as files addressed by block: one folder per scene, row block and column block.

A window read joins the names of its blocks with the folders, so Spark prunes them at run time and never opens the
blocks that no window meets (``operators.raster.clip_pixels`` with ``block``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lotseries.operators.raster import BLOCK_KEY, block_name, block_number

# Pixel rows and columns of a block: about a million pixels, some MB of Parquet.
BLOCK = 1024


def write_pixels(pixels: DataFrame, path: str, block: int = BLOCK) -> None:
    """Write ``scene_id, row, col`` and value columns, replacing the blocks that the pixels lie in.

    A block's rows come together before they are written, split by size if they are many, and are sorted,
    so row groups cover few pixel rows.
    """
    place = [block_number(F.col(c), block) for c in ("row", "col")]
    blocks = pixels.withColumn(BLOCK_KEY, block_name(F.col("scene_id"), *place))
    dealt = blocks.hint("rebalance", F.col(BLOCK_KEY)).sortWithinPartitions(BLOCK_KEY, "row", "col")
    writer = dealt.write.partitionBy(BLOCK_KEY).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def read_pixels(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Pixels of a store written from a table of this schema, with the name of their block."""
    full = StructType(list(schema)).add(BLOCK_KEY, StringType())
    return spark.read.schema(full).parquet(path)
