"""Harvest cycles: next harvest, crop age, gaps, renovations and validity.

All rules of a row depend on its lot and day only. So the master is first
reduced to one row per lot and day (combined before the shuffle), the rules run
there as windows per lot, and one join brings the result back to the rows. A
lot then never has more window rows than the calendar has days, even if it owns
a third of the master.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotseries.functions.season import harvest_day

# Thresholds of the cycle rules.
MAX_CYCLE_GAP_DAYS = 548
RENOVATION_MIN_AGE = 200
RENOVATION_NDVI = 0.2
VALID_MIN_ROWS = 7
VALID_MIN_AGE = 150

DAY_KEY = ["lot_id", "obs_date"]
CYCLE_COLUMNS = ["cycle_end", "crop_age_days", "data_gap", "valid_cycle"]


# All windows of the days run in one order, by lot and day, so a lot is sorted once. Frames only grow, and what lies
# ahead is a ``lead`` over nulls: frames that shrink cost quadratic time per lot.


def _forward() -> WindowSpec:
    return W.partitionBy("lot_id").orderBy("obs_date")


def _up_to_now() -> WindowSpec:
    return _forward().rowsBetween(W.unboundedPreceding, W.currentRow)


def _next_known(column: str) -> Column:
    """The value of the day, or else of the next day that has one."""
    ahead = F.expr(f"lead({column}) ignore nulls over (partition by lot_id order by obs_date)")
    return F.coalesce(F.col(column), ahead)


def lot_days(master: DataFrame) -> DataFrame:
    """One row per lot and day: observation counts, NDVI range, and whether a harvest ends there.

    ``row_count`` is 0 on harvest days without an observation.
    """
    event = "struct<obs_date:date, row_count:int, ndvi:double, is_harvest:boolean>"
    observed = F.struct("obs_date", F.lit(1), "ndvi_ref", F.lit(False)).cast(event)
    harvested = F.struct(harvest_day(F.col("harvest")), F.lit(0), F.lit(None), F.lit(True))
    events = F.when(
        F.col("harvest").isNotNull(), F.array(observed, harvested.cast(event))
    ).otherwise(F.array(observed))
    days = master.where("lot_id is not null").select("lot_id", F.inline(events))
    missing = (F.col("row_count") > 0) & F.col("ndvi").isNull()
    return (
        days.where("obs_date is not null")
        .groupBy("lot_id", "obs_date")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.min("ndvi").alias("ndvi_min"),
            F.max("ndvi").alias("ndvi_max"),
            F.max(missing).alias("ndvi_missing"),
            F.max("is_harvest").alias("is_harvest"),
        )
    )


def with_next_boundary(days: DataFrame, is_boundary: Column, name: str) -> DataFrame:
    """``name``: the first boundary on or after the day."""
    boundary = days.withColumn("boundary", F.when(is_boundary, F.col("obs_date")))
    return boundary.withColumn(name, _next_known("boundary")).drop("boundary")


def with_cycle_end(days: DataFrame) -> DataFrame:
    """Forward as-of: the next harvest on or after the day. Keeps observed days only."""
    return with_next_boundary(days, F.col("is_harvest"), "cycle_end").where("row_count > 0")


def _age_and_gap(days: DataFrame) -> DataFrame:
    """``data_gap`` and ``crop_age_days`` from ``previous_end``; no age in cycles with a gap."""
    gap = F.coalesce(F.date_diff("cycle_end", "previous_end") > MAX_CYCLE_GAP_DAYS, F.lit(False))
    age = F.when(~F.col("data_gap"), F.date_diff("obs_date", "previous_end"))
    return days.withColumn("data_gap", gap).withColumn("crop_age_days", age)


def with_age_and_gap(days: DataFrame) -> DataFrame:
    """Age since the previous *observed* cycle end, null in cycles with a data gap.

    Cycle ends never decrease along a lot and are null at most at its end, so
    the previous end is the last value before the latest change; for the open
    rows this is the lot's last cycle end.
    """
    before = F.lag("cycle_end").over(_forward())
    changed = days.withColumn(
        "left_end", F.when(~F.col("cycle_end").eqNullSafe(before), before)
    )
    previous = F.last("left_end", ignorenulls=True).over(_up_to_now())
    return _age_and_gap(changed.withColumn("previous_end", previous)).drop("left_end", "previous_end")


def with_repaired_age_and_gap(days: DataFrame) -> DataFrame:
    """The same from stored cycle ends in any order: the previous end is the lot's next smaller one,
    and for rows without an end the lot's largest."""
    # the order that ``with_valid_cycle`` needs too, so that a lot is sorted once
    by_end = W.partitionBy("lot_id").orderBy("cycle_end")
    before = F.lag("cycle_end").over(by_end)
    changed = days.withColumn("left_end", F.when(F.col("cycle_end") != before, before))
    smaller = F.last("left_end", ignorenulls=True).over(by_end.rowsBetween(W.unboundedPreceding, W.currentRow))
    largest = F.max("cycle_end").over(W.partitionBy("lot_id"))
    previous = F.when(F.col("cycle_end").isNull(), largest).otherwise(smaller)
    return _age_and_gap(changed.withColumn("previous_end", previous)).drop("left_end", "previous_end")


def with_renovation_candidates(days: DataFrame) -> DataFrame:
    """Mark the candidates for renovation days, and those that start an event.

    A candidate is an open day of more than 200 days of age with an NDVI below
    0.2. A candidate starts an event if the open day before it had no NDVI or
    one of at least 0.2. A day without a cycle end has no gap. Rows of one day
    count as ordered by NDVI, nulls last.
    """
    is_open = F.col("cycle_end").isNull()
    last_value = F.when(is_open & ~F.col("ndvi_missing"), F.col("ndvi_max"))
    marked = days.withColumns({"is_open": is_open, "before": F.lag(last_value).over(_forward())})
    candidate = F.col("is_open") & (F.col("crop_age_days") > RENOVATION_MIN_AGE) & (F.col("ndvi_min") < RENOVATION_NDVI)
    starts = F.col("before").isNull() | (F.col("before") >= RENOVATION_NDVI)
    flagged = marked.withColumn("candidate", F.coalesce(candidate, F.lit(False)))
    return flagged.withColumn("starts", F.col("candidate") & starts).drop("before")


def with_renovation_events(days: DataFrame) -> DataFrame:
    """Number the events of the candidates; candidates before any start form event 0.

    The first day of an event is the renovation day.
    """
    numbered = with_renovation_candidates(days).withColumns(
        {
            "event_id": F.sum(F.col("starts").cast("int")).over(_up_to_now()),
            "candidates_so_far": F.sum(F.col("candidate").cast("int")).over(_up_to_now()),
        }
    )
    first_of_event = F.col("starts") | (F.col("candidate") & (F.col("candidates_so_far") == 1))
    return numbered.withColumn("is_renovation", first_of_event).drop("starts", "candidates_so_far")


def renovation_points(days: DataFrame) -> DataFrame:
    """Renovation days with their event number; event 0 follows a low non-candidate."""
    return days.where("is_renovation").select(
        "lot_id", F.col("event_id").cast("int").alias("event_id"), F.col("obs_date").alias("renovation_date")
    )


def with_renovation_ends(days: DataFrame) -> DataFrame:
    """Close open days at the next renovation day.

    That is the next start of an event, or the lot's first candidate if that does not lie behind.
    """
    marked = with_renovation_candidates(days).withColumns(
        {"start": F.when(F.col("starts"), F.col("obs_date")), "low": F.when(F.col("candidate"), F.col("obs_date"))}
    )
    found = marked.withColumns(
        {"next_start": _next_known("start"), "next_low": _next_known("low"), "first_low": F.min("low").over(_up_to_now())}
    )
    none_behind = F.col("first_low").isNull() | (F.col("first_low") == F.col("obs_date"))
    end = F.coalesce("cycle_end", F.when(none_behind, F.col("next_low")).otherwise(F.col("next_start")))
    return found.withColumn("cycle_end", end).select(*days.columns)


def with_valid_cycle(days: DataFrame) -> DataFrame:
    """Valid cycle: known end and start, no gap, at least 7 rows and an age of 150 days."""
    cycle = W.partitionBy("lot_id", "cycle_end")
    usable = (
        F.col("cycle_end").isNotNull() & F.col("crop_age_days").isNotNull() & ~F.col("data_gap")
    )
    rows = F.sum(F.when(usable, F.col("row_count"))).over(cycle)
    age = F.max(F.when(usable, F.col("crop_age_days"))).over(cycle)
    valid = (
        F.col("cycle_end").isNotNull() & (rows >= VALID_MIN_ROWS) & (age >= VALID_MIN_AGE)
    )
    return days.withColumn("valid_cycle", F.coalesce(valid, F.lit(False)))


def with_valid_cycle_in_order(days: DataFrame) -> DataFrame:
    """``with_age_and_gap`` and ``with_valid_cycle`` of it, for cycle ends that never decrease along a lot.

    The days of a cycle follow each other and share its start and gap. Its last day then knows its number of
    rows and its greatest age, and the days before it look that day's verdict up.
    """
    after = F.lead(F.struct("cycle_end")).over(_forward())
    counted = days.withColumns(
        {
            "before": F.lag("cycle_end").over(_forward()),
            "after": after,
            "rows_so_far": F.sum("row_count").over(_up_to_now()),
        }
    )
    changes = ~F.col("cycle_end").eqNullSafe(F.col("before"))
    marked = counted.withColumns(
        {
            "left_end": F.when(changes, F.col("before")),
            "left_rows": F.when(changes, F.col("rows_so_far") - F.col("row_count")),
            "is_last": F.col("after").isNull() | ~F.col("cycle_end").eqNullSafe(F.col("after.cycle_end")),
        }
    )
    known = marked.withColumns(
        {
            "previous_end": F.last("left_end", ignorenulls=True).over(_up_to_now()),
            "rows_before": F.last("left_rows", ignorenulls=True).over(_up_to_now()),
        }
    )
    rows = F.col("rows_so_far") - F.coalesce("rows_before", F.lit(0))
    valid = (
        F.col("cycle_end").isNotNull()
        & (rows >= VALID_MIN_ROWS)
        & (F.col("crop_age_days") >= VALID_MIN_AGE)
    )
    judged = _age_and_gap(known).withColumn("verdict", F.when(F.col("is_last"), F.coalesce(valid, F.lit(False))))
    return judged.withColumn("valid_cycle", _next_known("verdict")).select(*days.columns, "data_gap", "crop_age_days", "valid_cycle")


def harvest_cycles(days: DataFrame) -> DataFrame:
    """Cycle ends from harvests alone, with age and gap."""
    return with_age_and_gap(with_cycle_end(days))


def renovated_cycles(days: DataFrame) -> DataFrame:
    """Cycle ends from harvests and renovations, with age, gap and validity."""
    closed = with_renovation_ends(harvest_cycles(days))
    return with_valid_cycle_in_order(closed.drop("data_gap", "crop_age_days"))


def attach(master: DataFrame, days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring columns of the day table to the rows; rows without a lot or date get no cycle.

    The key is (lot, day), so a hot lot spreads over its days.
    """
    narrow = days.select(F.col("lot_id").alias("_lot"), F.col("obs_date").alias("_day"), *columns)
    kept = master.drop(*columns)
    same = (F.col("lot_id") == F.col("_lot")) & (F.col("obs_date").cast("date") == F.col("_day"))
    joined = kept.join(narrow, same, "left").drop("_lot", "_day")
    flags = [c for c in columns if c in ("data_gap", "valid_cycle")]
    return joined.fillna(False, flags) if flags else joined


def attach_by_lot(master: DataFrame, days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``attach`` for a master in buckets by lot: a lot's days come as one map to its rows, so nothing is shuffled.

    The map has as many entries as the calendar has days. All rows of a lot meet in one task, so no lot may own
    a large share of the master.
    """
    entry = F.struct("obs_date", F.struct(*columns))
    by_lot = days.groupBy(F.col("lot_id").alias("_lot")).agg(F.map_from_entries(F.collect_list(entry)).alias("_days"))
    kept = master.drop(*columns)
    found = kept.join(by_lot, F.col("lot_id") == F.col("_lot"), "left")
    at = F.try_element_at("_days", F.col("obs_date").cast("date"))
    named = {c: F.coalesce(at[c], F.lit(False)) if c in ("data_gap", "valid_cycle") else at[c] for c in columns}
    return found.select(*kept.columns, *[v.alias(c) for c, v in named.items()])


def add_cycles(master: DataFrame, by_lot: bool = False) -> DataFrame:
    """Master with ``cycle_end``, ``crop_age_days``, ``data_gap`` and ``valid_cycle``.

    The master is read twice: two or three narrow columns for the day table,
    and whole rows for the join. Store it before (``plans.training``) if it is
    itself the result of a costly plan. ``by_lot`` says that it lies in buckets by lot.
    """
    way_back = attach_by_lot if by_lot else attach
    return way_back(master, renovated_cycles(lot_days(master)), CYCLE_COLUMNS)


REPAIRED_COLUMNS = ["crop_age_days", "data_gap", "valid_cycle"]


def repaired_days(master: DataFrame) -> DataFrame:
    """Age, gap and validity per lot and day, again from the cycle ends already stored."""
    days = (
        master.where("lot_id is not null and obs_date is not null")
        .groupBy("lot_id", F.col("obs_date").cast("date").alias("obs_date"))
        .agg(F.count("*").alias("row_count"), F.max("cycle_end").alias("cycle_end"))
    )
    return with_valid_cycle(with_repaired_age_and_gap(days))


def recompute_cycles(master: DataFrame, by_lot: bool = False) -> DataFrame:
    """Repair: the master with age, gap and validity computed again; ``by_lot`` as in ``add_cycles``."""
    way_back = attach_by_lot if by_lot else attach
    return way_back(master, repaired_days(master), REPAIRED_COLUMNS)
