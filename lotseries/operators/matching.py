"""Cleaning of index values and matching of two sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.functions.indices import within
from lotseries.schema import INDICES, VALID_RANGE


def clean_ranges(df: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Set index means that are infinite, NaN or out of range to null."""
    return df.withColumns(
        {f"{i}_mean": within(F.col(f"{i}_mean"), *VALID_RANGE[i]) for i in indices}
    )


def match_sources(
    ref: DataFrame, stac: DataFrame, indices: Sequence[str] = INDICES, match_nulls: bool = False
) -> DataFrame:
    """Rows present in both sources for a lot and date.

    Means become ``{index}_ref`` and ``{index}_stac``; the year is that of the
    reference source. With ``match_nulls`` null keys match each other: every row without a lot
    then meets every such row of the other source on its date, on one key.
    """
    left = ref.select(
        "lot_id", "obs_date", "year", *[F.col(f"{i}_mean").alias(f"{i}_ref") for i in indices]
    )
    right = stac.select(
        F.col("lot_id").alias("stac_lot"),
        F.col("obs_date").alias("stac_date"),
        "image_id",
        *[F.col(f"{i}_mean").alias(f"{i}_stac") for i in indices],
    )
    equal = Column.eqNullSafe if match_nulls else Column.__eq__
    same = equal(F.col("lot_id"), F.col("stac_lot")) & equal(F.col("obs_date"), F.col("stac_date"))
    return left.join(right, same).drop("stac_lot", "stac_date")
