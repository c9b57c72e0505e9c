"""Season keys, the master table and the season-calendar rules for age and gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotseries.functions.season import (
    harvest_day,
    lot_season,
    previous_season,
    report_season,
    season_label,
)


def add_season(observations: DataFrame) -> DataFrame:
    """Add the season of the observation date and the (lot, season) key."""
    season = season_label(F.col("obs_date"))
    return observations.withColumn("season", season).withColumn(
        "lot_season", lot_season(F.col("lot_id"), F.col("season"))
    )


def add_yield_key(yields: DataFrame, lot: str = "lot", season: str = "season") -> DataFrame:
    """Add the (lot, season) key to report rows; the report writes ``Zafra 2019-2020``."""
    return yields.withColumn("lot_season", lot_season(F.col(lot), report_season(F.col(season))))


def build_master(
    observations: DataFrame,
    yields: DataFrame,
    columns: Sequence[str] | None = None,
    season: str = "season",
) -> DataFrame:
    """Observations with the yield rows of their lot and season.

    Every observation is kept; several yield rows for a key multiply it. The
    season cell of the report is kept as ``report_season``. Whether the yields
    are broadcast is left to Spark's own size check; a hot key on the
    observation side is split by the adaptive skew join.
    """
    wanted = list(columns) if columns is not None else [c for c in yields.columns if c != "lot_season"]
    right = yields.select(
        "lot_season", *[F.col(c).alias("report_season" if c == season else c) for c in wanted]
    )
    return observations.join(right, "lot_season", "left")


def build_master_by_lot(observations: DataFrame, yields: DataFrame, lot: str = "lot", season: str = "season") -> DataFrame:
    """``build_master`` for observations that lie by lot, and yields whose key begins with the column ``lot``.

    The yields of a lot come to its observations as one map by season, so the observations stay where they are. All
    rows of a lot meet in one task, so no lot may own a large share of them.
    """
    wanted = [c for c in yields.columns if c != "lot_season"]
    named = [F.col(c).alias("report_season" if c == season else c) for c in wanted]
    known = yields.where(F.col("lot_season").isNotNull()).select(F.col(lot).alias("_lot"), F.col("lot_season").alias("_key"), F.struct(*named).alias("_row"))
    by_season = known.groupBy("_lot", "_key").agg(F.collect_list("_row").alias("_rows"))
    by_lot = by_season.groupBy("_lot").agg(F.map_from_entries(F.collect_list(F.struct("_key", "_rows"))).alias("_yields"))
    found = observations.join(by_lot, F.col("lot_id") == F.col("_lot"), "left")
    others = [c for c in observations.columns if c != "lot_season"]
    return found.select("lot_season", *others, F.inline_outer(F.try_element_at("_yields", F.col("lot_season"))))


# --- rules that follow the season calendar -----------------------------------------------
#
# They all read one table of the (lot, season) pairs of the master, which holds what the rules ask of
# the seasons before. A lot has few pairs however many rows it has, and the aggregation that finds
# them combines rows before the shuffle, so its windows per lot stay small. The rows look a pair up
# once; the rules are then plain expressions.

LOOKUP = ["harvest_before", "season_before_harvest", "season_gap"]


def lot_seasons(master: DataFrame) -> DataFrame:
    """What each (lot, season) knows of the seasons before: ``lot_id, season`` and

    * ``harvest_before``: the latest earlier harvest, for seasons that have one of their own,
    * ``season_before_harvest``: the harvest of the season observed before, null if that has none,
    * ``season_gap``: the season has a harvest, the calendar season before has none, an earlier one has.

    If several previous harvests match, the latest counts.
    """
    triples = master.where("lot_id is not null and season is not null").select("lot_id", "season", "harvest").distinct()
    day = harvest_day(F.col("harvest"))
    order = W.partitionBy("lot_id").orderBy("season", day.asc_nulls_last(), F.col("harvest").asc_nulls_last())
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    lagged = triples.withColumns(
        {
            "any": harvest_day(F.lag("harvest").over(order)),
            "known": F.when(F.col("harvest").isNotNull(), harvest_day(F.last("harvest", True).over(earlier))),
        }
    )
    seasons = lagged.groupBy("lot_id", "season").agg(
        F.max("known").alias("harvest_before"),
        F.max("any").alias("season_before_harvest"),
        (F.count("harvest") > 0).alias("has_harvest"),
    )
    by_season = W.partitionBy("lot_id").orderBy("season").rowsBetween(W.unboundedPreceding, -1)
    last_known = F.last(F.when(F.col("has_harvest"), F.col("season")), True).over(by_season)
    gap = F.col("has_harvest") & (F.col("last_known") != previous_season(F.col("season")))
    return (
        seasons.withColumn("last_known", last_known)
        .withColumn("season_gap", F.coalesce(gap, F.lit(False)))
        .select("lot_id", "season", *LOOKUP)
    )


def with_lot_seasons(master: DataFrame, seasons: DataFrame | None = None) -> DataFrame:
    """Rows with the columns of their (lot, season) in ``lot_seasons``, which may be given.

    The join is on the combined key on purpose: the lookup, grouped by (lot,
    season), then gets a shuffle of its own, and only a join of two shuffles can
    have a hot key split by the adaptive skew join.
    """
    key = lot_season(F.col("lot_id"), F.col("season"))
    lookup = (lot_seasons(master) if seasons is None else seasons).select(key.alias("_key"), *LOOKUP)
    return master.withColumn("_key", key).join(lookup, "_key", "left").drop("_key")


def _known_age() -> Column:
    return F.date_diff("obs_date", "harvest_before")


def _ratoon_age() -> Column:
    own = harvest_day(F.col("harvest"))
    start = F.when(F.col("obs_date") > own, own).otherwise(F.col("season_before_harvest"))
    return F.when(F.col("harvest").isNotNull(), F.date_diff("obs_date", start))


def _season_gap() -> Column:
    return F.coalesce("season_gap", F.lit(False))


def age_since_known_harvest(master: DataFrame, seasons: DataFrame | None = None) -> DataFrame:
    """Age from the latest earlier season that has a harvest."""
    return with_lot_seasons(master, seasons).withColumn("crop_age_days", _known_age()).drop(*LOOKUP)


def age_since_previous_season(master: DataFrame, seasons: DataFrame | None = None) -> DataFrame:
    """Age from the season observed before; null if that season has no harvest."""
    age = F.date_diff("obs_date", "season_before_harvest")
    return with_lot_seasons(master, seasons).withColumn("crop_age_days", age).drop(*LOOKUP)


def age_with_ratoon(master: DataFrame, seasons: DataFrame | None = None) -> DataFrame:
    """Age from the season's own harvest after it, from the previous one before it."""
    return with_lot_seasons(master, seasons).withColumn("crop_age_days", _ratoon_age()).drop(*LOOKUP)


def season_gaps(master: DataFrame) -> DataFrame:
    """(lot, season) pairs with a harvest whose previous season has none, first seasons excepted."""
    return lot_seasons(master).where("season_gap").select("lot_id", "season")


def flag_season_gaps(master: DataFrame, age: str = "crop_age_days", seasons: DataFrame | None = None) -> DataFrame:
    """Add ``data_gap`` by the season rule; the age of flagged rows becomes null."""
    found = with_lot_seasons(master.drop("data_gap"), seasons)
    return found.withColumns({"data_gap": _season_gap(), age: F.when(~_season_gap(), F.col(age))}).drop(*LOOKUP)


def ratoon_age_and_gaps(master: DataFrame, seasons: DataFrame | None = None) -> DataFrame:
    """``age_with_ratoon`` and ``flag_season_gaps`` of it, by one lookup."""
    found = with_lot_seasons(master.drop("data_gap", "crop_age_days"), seasons)
    age = F.when(~_season_gap(), _ratoon_age())
    return found.withColumns({"crop_age_days": age, "data_gap": _season_gap()}).drop(*LOOKUP)


def rollback_to_first_age(master: DataFrame, seasons: DataFrame | None = None) -> DataFrame:
    """Drop the gap flag and compute the age by the first rule again."""
    return age_since_known_harvest(master.drop("data_gap", "crop_age_days"), seasons)
