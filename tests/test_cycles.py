"""Cycle rules: hand-made lots, and random lots against a row-by-row rule book."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from lotseries.operators import cycles as c

SCHEMA = "lot_id string, obs_date date, ndvi_ref double, harvest string"
D0 = date(2020, 1, 1)


def day(n: int) -> date:
    return D0 + timedelta(days=n)


def text(n: int) -> str:
    return day(n).strftime("%d/%m/%Y")


def by_hand(rows: list[tuple]) -> list[tuple]:
    """The rules applied to the rows of each lot, one after the other."""
    out = []
    for lot in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lot and lot is not None]
        if lot is None:
            out += [(*r, None, None, False, False) for r in rows if r[0] is None]
            continue
        harvests = {
            date(*map(int, reversed(r[3].split("/")))) for r in mine if r[3] is not None
        }
        end = {d: min((h for h in harvests if h >= d), default=None) for d in {r[1] for r in mine}}

        def ages(end):
            ends = sorted({e for e in end.values() if e})
            age, gap = {}, {}
            for d, e in end.items():
                before = [x for x in ends if e is None or x < e]
                prev = before[-1] if before else None
                gap[d] = bool(e and prev and (e - prev).days > 548)
                age[d] = (d - prev).days if prev and not gap[d] else None
            return age, gap

        age, gap = ages(end)
        open_rows = sorted(
            (r for r in mine if end[r[1]] is None),
            key=lambda r: (r[1], r[2] is None, r[2] or 0.0),
        )
        candidates = []
        for i, r in enumerate(open_rows):
            prev = open_rows[i - 1][2] if i else None
            if age[r[1]] is not None and age[r[1]] > 200 and r[2] is not None and r[2] < 0.2:
                candidates.append((r[1], prev is None or prev >= 0.2))
        events: dict[int, date] = {}
        for at, _ in candidates:
            number = sum(starts for other, starts in candidates if other <= at)
            events[number] = min(events.get(number, at), at)
        for d, e in end.items():
            if e is None:
                end[d] = min((x for x in events.values() if x >= d), default=None)
        age, gap = ages(end)
        good = set()
        for e in {x for x in end.values() if x}:
            usable = [r for r in mine if end[r[1]] == e and age[r[1]] is not None]
            if len(usable) >= 7 and max(age[r[1]] for r in usable) >= 150:
                good.add(e)
        out += [(*r, end[r[1]], age[r[1]], gap[r[1]], end[r[1]] in good) for r in mine]
    return out


def run(spark, rows):
    df = c.add_cycles(spark.createDataFrame(rows, SCHEMA))
    return [tuple(r) for r in df.select("lot_id", "obs_date", "ndvi_ref", "harvest", *c.CYCLE_COLUMNS).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(str(v) for v in r))


def lot(name, days, harvests=None, ndvi=0.6):
    harvests = harvests or {}
    return [(name, day(n), ndvi, text(harvests[n]) if n in harvests else None) for n in days]


def test_no_harvest_one_harvest_and_the_harvest_day(spark):
    rows = lot("none", [0, 30]) + lot("one", [0, 100, 130], {0: 100})
    got = {(r[0], r[1]): r[4:] for r in run(spark, rows)}
    assert got[("none", day(0))] == (None, None, False, False)
    assert got[("one", day(0))] == (day(100), None, False, False)
    assert got[("one", day(100))] == (day(100), None, False, False)
    assert got[("one", day(130))] == (None, 30, False, False)


def test_a_gap_starts_after_548_days(spark):
    rows = [
        ("ok", day(0), 0.6, text(10)),
        ("ok", day(500), 0.6, text(558)),
        ("bad", day(0), 0.6, text(10)),
        ("bad", day(500), 0.6, text(559)),
    ]
    got = {(r[0], r[1]): r[4:7] for r in run(spark, rows)}
    assert got[("ok", day(500))] == (day(558), 490, False)
    assert got[("bad", day(500))] == (day(559), None, True)


def test_the_previous_end_is_the_previous_observed_one(spark):
    # the harvest of day 200 ends no observed cycle: nothing was seen between day 100 and 200
    rows = [("a", day(90), 0.6, text(100)), ("a", day(250), 0.6, text(200)), ("a", day(260), 0.6, text(300))]
    got = {r[1]: r[4:6] for r in run(spark, rows)}
    assert got[day(250)] == (day(300), 150) and got[day(260)] == (day(300), 160)


@pytest.mark.parametrize("count, last, valid", [(6, 160, False), (7, 160, True), (7, 150, True), (7, 149, False)])
def test_valid_cycles_need_seven_rows_and_150_days(spark, count, last, valid):
    days = [10 + i for i in range(count - 1)] + [last]
    rows = [("a", day(-5), 0.6, text(0))] + [("a", day(n), 0.6, text(300)) for n in days]
    got = run(spark, rows)
    assert {r[7] for r in got if r[4] == day(300)} == {valid}


def test_fan_out_rows_count_for_validity(spark):
    rows = [("a", day(-5), 0.6, text(0))] + [("a", day(n), 0.6, text(h)) for n in (10, 20, 30, 160) for h in (300, 310)]
    assert {r[7] for r in run(spark, rows) if r[1] >= day(10)} == {True}


def test_renovations_need_more_than_200_days_and_a_value_below_the_limit(spark):
    rows = [
        ("a", day(-5), 0.6, text(0)),
        ("a", day(200), 0.1, None),  # age 200: too young
        ("a", day(201), 0.15, None),  # candidate after a low non-candidate: event 0
        ("a", day(230), 0.2, None),  # not below the limit
        ("a", day(240), 0.1, None),  # recovered in between: next event
        ("a", day(250), 0.1, None),
        ("a", day(260), None, None),
        ("a", day(270), 0.1, None),  # after a missing value
        ("a", day(280), 0.9, None),
    ]
    days = c.with_renovation_events(c.harvest_cycles(c.lot_days(spark.createDataFrame(rows, SCHEMA))))
    points = sorted((r.event_id, r.renovation_date) for r in c.renovation_points(days).collect())
    assert points == [(0, day(201)), (1, day(240)), (2, day(270))]
    got = {r[1]: r[4:6] for r in run(spark, rows)}
    assert got[day(200)] == (day(201), 200)
    assert got[day(230)] == (day(240), 29)
    assert got[day(280)] == (None, 10)


def test_rows_without_lot_or_date_get_no_cycle(spark):
    rows = [(None, day(0), 0.1, text(10)), ("a", None, 0.1, text(10)), ("a", day(1), 0.5, text(10))]
    got = {(r[0], r[1]): r[4:] for r in run(spark, rows)}
    assert got[(None, day(0))] == (None, None, False, False)
    assert got[("a", None)] == (None, None, False, False)
    assert got[("a", day(1))][0] == day(10)


def random_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for k in range(12):
        harvests = sorted(rng.sample(range(0, 2500), rng.randint(0, 4)))
        for _ in range(rng.randint(1, 60)):
            n = rng.randrange(0, 3200)
            ndvi = rng.choice([None, 0.05, 0.1, 0.19, 0.2, 0.3, 0.7, 0.8])
            harvest = text(rng.choice(harvests)) if harvests and rng.random() < 0.5 else None
            rows += [(f"lot{k}", day(n), ndvi, harvest)] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_random_lots_follow_the_rule_book(spark, seed):
    rows = random_rows(seed)
    assert ordered(run(spark, rows)) == ordered(by_hand(rows))


def test_a_hot_lot_keeps_one_window_row_per_day(spark):
    rows = [r for r in random_rows(9) if r[0] != "lot3"]
    hot = [("lot3", day(n % 900), 0.1 if n % 7 else 0.6, text(400)) for n in range(6000)]
    df = spark.createDataFrame(rows + hot, SCHEMA)
    per_lot = {r.lot_id: r["count"] for r in c.lot_days(df).groupBy("lot_id").count().collect()}
    assert per_lot["lot3"] == 900
    assert ordered(run(spark, rows + hot)) == ordered(by_hand(rows + hot))


def test_recompute_restores_spoiled_columns_and_changes_nothing_twice(spark):
    from pyspark.sql import functions as F

    good = c.add_cycles(spark.createDataFrame(random_rows(3), SCHEMA))
    columns = ["lot_id", "obs_date", "ndvi_ref", "harvest", *c.CYCLE_COLUMNS]
    spoiled = good.withColumns({"crop_age_days": F.lit(-1), "data_gap": F.lit(True), "valid_cycle": F.lit(False)})
    fixed = c.recompute_cycles(spoiled)
    again = c.recompute_cycles(fixed)
    expected = ordered(map(tuple, good.select(columns).collect()))
    assert ordered(map(tuple, fixed.select(columns).collect())) == expected
    assert ordered(map(tuple, again.select(columns).collect())) == expected


def test_windows_run_on_days_only(spark, plan):
    text_plan = plan(c.add_cycles(spark.createDataFrame(random_rows(1), SCHEMA)))
    physical = text_plan[text_plan.index("== Physical Plan ==") :]
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    assert "EvalPython" not in physical
    windows = physical.index("Window")
    # below the windows: an aggregation per lot and day, combined before its shuffle
    assert "partial_sum(row_count" in physical[windows:]


def test_all_windows_of_the_days_share_one_sort(spark, plan):
    days = c.lot_days(spark.createDataFrame(random_rows(1), SCHEMA))
    repaired = c.repaired_days(spark.createDataFrame([], "lot_id string, obs_date date, cycle_end date"))
    for rules, windows in ((c.renovated_cycles(days), 8), (repaired, 4)):
        text_plan = plan(rules)
        physical = text_plan[text_plan.index("== Physical Plan ==") :]
        assert physical.count("Sort [") == 1 and physical.count("- Window [") + physical.startswith("Window") <= windows


@pytest.mark.parametrize("seed", [3, 4])
def test_validity_in_order_equals_validity_in_any_order(spark, seed):
    rows = [r for r in random_rows(seed) if r[0] is not None]
    closed = c.with_renovation_ends(c.harvest_cycles(c.lot_days(spark.createDataFrame(rows, SCHEMA))))
    bare = closed.drop("data_gap", "crop_age_days")
    names = ["lot_id", "obs_date", "row_count", *c.CYCLE_COLUMNS]
    got = c.with_valid_cycle_in_order(bare).select(names)
    want = c.with_valid_cycle(c.with_age_and_gap(bare)).select(names)
    assert ordered(map(tuple, got.collect())) == ordered(map(tuple, want.collect()))
