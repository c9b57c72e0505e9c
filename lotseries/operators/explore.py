"""Diagnostics of matched sources. Each is one aggregate pass over the rows.

The three indices are aggregated side by side and turned into rows only
afterwards, so no row is copied before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.operators.sampling import sample_rows
from lotseries.schema import INDICES

# Histogram bins, size of the scatter sample.
HISTOGRAM_BINS = 100
SCATTER_ROWS = 60_000


def by_index(
    df: DataFrame,
    measures: Callable[[str], dict[str, Column]],
    indices: Sequence[str] = INDICES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Aggregate the same measures for every index; one output row per group and index."""
    packed = [
        F.struct(F.lit(i).alias("index"), *[c.alias(n) for n, c in measures(i).items()]).alias(i)
        for i in indices
    ]
    return df.groupBy(*by).agg(*packed).select(*by, F.inline(F.array(*indices)))


def residual(index: str) -> Column:
    return F.col(f"{index}_stac") - F.col(f"{index}_ref")


def matched_counts(matched: DataFrame) -> DataFrame:
    """Rows, lots, dates and the sorted list of years."""
    return matched.agg(
        F.count("*").alias("rows"),
        F.count_distinct("lot_id").alias("lots"),
        F.count_distinct("obs_date").alias("dates"),
        F.array_sort(F.collect_set("year")).alias("years"),
    )


def source_summary(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Mean and sample std of both sources and of the bias, and Pearson's r."""

    def measures(i: str) -> dict[str, Column]:
        stac, ref = F.col(f"{i}_stac"), F.col(f"{i}_ref")
        both = ref.isNotNull() & stac.isNotNull()
        return {
            "stac_mean": F.avg(stac),
            "stac_std": F.stddev_samp(stac),
            "ref_mean": F.avg(ref),
            "ref_std": F.stddev_samp(ref),
            "bias_mean": F.avg(residual(i)),
            "bias_std": F.stddev_samp(residual(i)),
            "pearson_r": F.corr(F.when(both, stac), F.when(both, ref)),
        }

    return by_index(matched, measures, indices)


def residuals(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    return matched.withColumns({f"{i}_residual": residual(i) for i in indices})


def bias_by_year(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Mean and sample std of the bias per index and year."""
    return by_index(
        matched,
        lambda i: {"bias_mean": F.avg(residual(i)), "bias_std": F.stddev_samp(residual(i))},
        indices,
        ["year"],
    )


def residual_histogram(
    matched: DataFrame, indices: Sequence[str] = INDICES, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width histograms of the residuals on [min, max] per index; the maximum is in the last bin.

    Reads the rows twice for all indices, first for the bounds: store them if they are a costly join.
    """
    ends = [F.struct(F.min(residual(i)).alias("lo"), F.max(residual(i)).alias("hi")).alias(i) for i in indices]
    bounds = matched.agg(F.struct(*ends)).scalar()
    values = [
        F.struct(F.lit(i).alias("index"), residual(i).alias("value"), bounds[i]["lo"].alias("lo"), bounds[i]["hi"].alias("hi"))
        for i in indices
    ]
    rows = matched.select(F.inline(F.array(*values))).where("value is not null")
    position = F.floor((F.col("value") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins)
    # a single value has no width: it is drawn in the middle of a unit-wide range
    bin_no = F.coalesce(F.least(position, F.lit(bins - 1)), F.lit(bins // 2)).cast("int")
    return rows.groupBy("index", bin_no.alias("bin")).agg(F.count("*").alias("rows"))


def line_fit(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Least-squares line ``ref = slope * stac + intercept`` over complete pairs."""

    def measures(i: str) -> dict[str, Column]:
        stac, ref = F.col(f"{i}_stac"), F.col(f"{i}_ref")
        return {
            "pairs": F.regr_count(ref, stac),
            "slope": F.regr_slope(ref, stac),
            "intercept": F.regr_intercept(ref, stac),
        }

    return by_index(matched, measures, indices)


def identity_range(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Ends of the identity line: the joint minimum and maximum of both sources."""

    def measures(i: str) -> dict[str, Column]:
        pair = (f"{i}_stac", f"{i}_ref")
        return {
            "low": F.least(*[F.min(c) for c in pair]),
            "high": F.greatest(*[F.max(c) for c in pair]),
        }

    return by_index(matched, measures, indices)


def scatter_sample(matched: DataFrame, rows: int = SCATTER_ROWS, seed: int = 42) -> DataFrame:
    return sample_rows(matched, rows, seed)
