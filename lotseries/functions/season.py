"""Season labels, join keys and harvest dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: first month of a season (a season runs November to October).
SEASON_FIRST_MONTH = 11


def season_label(day: Column) -> Column:
    """``2020_2021`` for any day from November 2020 to October 2021."""
    start = F.year(day) - F.when(F.month(day) >= SEASON_FIRST_MONTH, 0).otherwise(1)
    return F.concat(start.cast("string"), F.lit("_"), (start + 1).cast("string"))


def previous_season(season: Column) -> Column:
    """``2020_2021`` -> ``2019_2020``; null for a label that does not start with a year."""
    start = F.split_part(season, F.lit("_"), F.lit(1))
    return F.concat((start.try_cast("int") - 1).cast("string"), F.lit("_"), start)


def lot_season(lot: Column, season: Column) -> Column:
    """Join key of a lot in a season; null if either part is null."""
    return F.concat(lot, F.lit("_"), season)


def report_season(text: Column) -> Column:
    """Season label of a report cell such as ``Zafra 2019-2020``."""
    return F.replace(F.substring(text, 7, 1 << 30), F.lit("-"), F.lit("_"))


def harvest_day(text: Column) -> Column:
    """Day of a ``DD/MM/YYYY`` cell; null for an impossible date."""
    return F.try_to_date(text, "d/M/yyyy")
