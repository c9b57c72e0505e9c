"""Analytical queries and chart feeds over the master table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotseries.operators.cycles import RENOVATION_MIN_AGE, RENOVATION_NDVI
from lotseries.operators.sampling import sample_groups

# Age limit of the renovation report, cycles a growth curve lot must have.
REPORT_MIN_AGE = 300
GROWTH_MIN_CYCLES = 2
# Sample sizes and seed of the chart feeds.
GROWTH_LOTS = 75
RENOVATED_CYCLES = 50
SAMPLE_SEED = 42
# Palette sizes of the charts.
HISTORY_COLORS = 15
CURVE_COLORS = 10


def ml_dataset(master: DataFrame) -> DataFrame:
    """Rows of valid cycles that have a yield."""
    return master.where(F.col("valid_cycle") & F.col("harvest").isNotNull())


def dataset_size(dataset: DataFrame) -> DataFrame:
    """Rows and distinct (lot, season) samples."""
    return dataset.agg(
        F.count("*").alias("rows"), F.count_distinct("lot_season").alias("samples")
    )


def cycle_length_buckets(master: DataFrame) -> DataFrame:
    """Share of valid cycles by their greatest age: 300-350, 350-400 and other."""
    lengths = (
        master.where("valid_cycle")
        .groupBy("lot_id", "cycle_end")
        .agg(F.max("crop_age_days").alias("days"))
    )
    days = F.col("days")
    bucket = (
        F.when((days >= 300) & (days < 350), "300-350")
        .when((days >= 350) & (days <= 400), "350-400")
        .otherwise("other")
    )
    counts = lengths.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("cycles"))
    # three rows at most
    share = F.col("cycles") / F.sum("cycles").over(W.partitionBy())
    return counts.withColumn("share", share)


def _low_index(min_age: int) -> Column:
    return (
        ~F.col("data_gap")
        & (F.col("crop_age_days") > min_age)
        & (F.col("ndvi_ref") < RENOVATION_NDVI)
    )


def renovated_harvests(master: DataFrame) -> DataFrame:
    """First date and least age of low NDVI in old crops, per lot and harvest."""
    return (
        master.where(_low_index(REPORT_MIN_AGE))
        .groupBy("lot_id", "harvest")
        .agg(
            F.min("obs_date").alias("renovation_date"),
            F.min("crop_age_days").alias("age_at_renovation"),
            F.min("ndvi_ref").alias("min_ndvi_ref"),
        )
    )


def renovation_report(master: DataFrame) -> DataFrame:
    """``renovated_harvests`` rounded and in order, missing harvests last."""
    rounded = renovated_harvests(master).withColumn("min_ndvi_ref", F.round("min_ndvi_ref", 4))
    return rounded.orderBy("lot_id", F.col("harvest").asc_nulls_last())


def lot_history(master: DataFrame, lots: DataFrame, in_order: bool = True) -> DataFrame:
    """NDVI history of the lots in a list (column ``lot_id``); ``in_order`` by lot and day, which readers that sort need not have."""
    history = (
        master.where("ndvi_ref is not null")
        .join(lots.select("lot_id"), "lot_id", "left_semi")
        .select("lot_id", "obs_date", "ndvi_ref", "crop_age_days", "cycle_end")
    )
    return history.orderBy("lot_id", "obs_date", "ndvi_ref") if in_order else history


def renovation_markers(master: DataFrame, lots: DataFrame) -> DataFrame:
    """First low-NDVI row of a cycle, two kinds.

    ``before_harvest``: cycles of rows with a yield, before the cycle's end.
    ``detected``: cycles of rows without a yield. Equal dates are settled by
    NDVI, then age.
    """
    low = master.where(_low_index(RENOVATION_MIN_AGE) & F.col("cycle_end").isNotNull()).join(
        lots.select("lot_id"), "lot_id", "left_semi"
    )
    kind = F.when(F.col("harvest").isNull(), "detected").when(
        F.col("obs_date") < F.col("cycle_end"), "before_harvest"
    )
    first = F.min(F.struct("obs_date", "ndvi_ref", "crop_age_days")).alias("first")
    return (
        low.withColumn("kind", kind)
        .where("kind is not null")
        .groupBy("kind", "lot_id", "cycle_end")
        .agg(first)
        .select("kind", "lot_id", "cycle_end", "first.*")
    )


def growth_lots(master: DataFrame, min_cycles: int = GROWTH_MIN_CYCLES) -> DataFrame:
    """Lots with enough distinct harvests among rows with an age and a corrected NDVI."""
    return (
        master.where(
            "crop_age_days is not null and harvest is not null and ndvi_corrected is not null"
        )
        .groupBy("lot_id")
        .agg(F.count_distinct("harvest").alias("cycles"))
        .where(F.col("cycles") >= min_cycles)
    )


def growth_sample(master: DataFrame, n: int = GROWTH_LOTS, seed: int = SAMPLE_SEED) -> DataFrame:
    return sample_groups(growth_lots(master).select("lot_id"), n, seed)


def growth_curves(master: DataFrame, lots: DataFrame, in_order: bool = True) -> DataFrame:
    """NDVI against age for the lots in a list; ``in_order`` by lot, harvest and age."""
    curves = (
        master.where("crop_age_days is not null and ndvi_corrected is not null")
        .join(lots.select("lot_id"), "lot_id", "left_semi")
        .select(
            "lot_id",
            "crop_age_days",
            "ndvi_corrected",
            "ndvi_ref",
            "harvest",
            "obs_date",
            "image_id",
        )
    )
    return curves.orderBy("lot_id", F.col("harvest").asc_nulls_last(), "crop_age_days", "image_id") if in_order else curves


def sampled_renovations(
    master: DataFrame, n: int = RENOVATED_CYCLES, seed: int = SAMPLE_SEED
) -> DataFrame:
    """Seeded sample of renovated (lot, harvest) pairs."""
    flagged = renovated_harvests(master).drop("min_ndvi_ref")
    return sample_groups(flagged, n, seed, ["lot_id", "harvest"])


def renovated_history(master: DataFrame, sampled: DataFrame, in_order: bool = True) -> DataFrame:
    """Whole history of the lots of the sampled renovations; ``in_order`` by lot and day."""
    history = (
        master.where(~F.col("data_gap") & F.col("ndvi_ref").isNotNull())
        .join(sampled.select("lot_id"), "lot_id", "left_semi")
        .select("lot_id", "harvest", "obs_date", "crop_age_days", "ndvi_ref")
    )
    return history.orderBy("lot_id", "obs_date", "ndvi_ref") if in_order else history


def values_at_events(history: DataFrame, events: DataFrame) -> DataFrame:
    """NDVI and age of a lot on the day of each event; null if the day is missing.

    If a day has several rows, the one with the least NDVI counts.
    """
    found = (
        history.join(
            events.select("lot_id", F.col("renovation_date").alias("obs_date")).distinct(),
            ["lot_id", "obs_date"],
            "left_semi",
        )
        .groupBy("lot_id", F.col("obs_date").alias("renovation_date"))
        .agg(F.min(F.struct("ndvi_ref", "crop_age_days")).alias("at"))
    )
    joined = events.where("harvest is not null").join(
        found, ["lot_id", "renovation_date"], "left"
    )
    return joined.select(
        "lot_id",
        "harvest",
        "renovation_date",
        F.round("at.ndvi_ref", 4).alias("ndvi"),
        F.col("at.crop_age_days").alias("age"),
    )


def cycle_traces(
    points: DataFrame,
    cycle: str,
    order: str,
    series: dict[str, Column],
    chunk: Column,
    colors: int = CURVE_COLORS,
    keep_open: bool = False,
) -> DataFrame:
    """Parallel arrays per lot, cycle and ``chunk`` (the calendar year, or the year of age), sorted by ``order``.

    Equal points are one entry of the arrays, with their number in ``copies``, so an array holds the
    different points of one year. ``color`` is the rank of the cycle among the lot's, modulo the palette size.
    With ``keep_open`` the points without a cycle form one more trace, whose color is null.
    """
    names = list(series)
    rows = points if keep_open else points.where(F.col(cycle).isNotNull())
    named = [c.alias(n) for n, c in series.items()]
    counted = (
        rows.select("lot_id", cycle, chunk.cast("int").alias("chunk"), F.col(order).alias("_at"), *named)
        .groupBy("lot_id", cycle, "chunk", "_at", *names)
        .agg(F.count("*").cast("int").alias("copies"))
    )
    traces = counted.groupBy("lot_id", cycle, "chunk").agg(
        F.sort_array(F.collect_list(F.struct("_at", *names, "copies"))).alias("_points")
    )
    rank = F.dense_rank().over(W.partitionBy("lot_id").orderBy(F.col(cycle).asc_nulls_last())) - 1
    return traces.select(
        "lot_id",
        cycle,
        "chunk",
        *[F.col(f"_points.{n}").alias(n) for n in (*names, "copies")],
        F.when(F.col(cycle).isNotNull(), rank % colors).alias("color"),
    )


def history_traces(history: DataFrame) -> DataFrame:
    """Traces of ``lot_history``: one per cycle, and one for the open points."""
    series = {
        "dates": F.col("obs_date").cast("string"),
        "ndvi": F.round("ndvi_ref", 4),
        "age": F.col("crop_age_days"),
    }
    return cycle_traces(history, "cycle_end", "obs_date", series, F.year("obs_date"), HISTORY_COLORS, True)


def growth_traces(curves: DataFrame) -> DataFrame:
    """Traces of ``growth_curves``, ordered by age."""
    series = {
        "age": F.col("crop_age_days"),
        "stac": F.round("ndvi_corrected", 4),
        "ref": F.round("ndvi_ref", 4),
        "dates": F.col("obs_date").cast("string"),
        "images": F.col("image_id"),
    }
    return cycle_traces(curves, "harvest", "crop_age_days", series, F.floor(F.col("crop_age_days") / 365))


def renovated_traces(history: DataFrame) -> DataFrame:
    """Traces of ``renovated_history``, one per harvest."""
    series = {
        "dates": F.col("obs_date").cast("string"),
        "age": F.col("crop_age_days"),
        "ndvi": F.round("ndvi_ref", 4),
    }
    return cycle_traces(history, "harvest", "obs_date", series, F.year("obs_date"))


def traces_json(traces: DataFrame, cycle: str, without: Sequence[str] = ()) -> DataFrame:
    """One JSON text per trace row."""
    body = [c for c in traces.columns if c not in ("lot_id", *without)]
    return traces.select("lot_id", cycle, "chunk", F.to_json(F.struct(*body)).alias("trace"))
