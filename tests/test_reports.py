from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lotseries.operators import reports as rp

D0 = date(2021, 1, 1)
SCHEMA = (
    "lot_id string, obs_date date, image_id string, lot_season string, harvest string, ndvi_ref double, "
    "ndvi_corrected double, cycle_end date, crop_age_days int, data_gap boolean, valid_cycle boolean"
)


def row(lot, n, harvest="10/06/2021", ndvi=0.5, end=160, age=100, gap=False, valid=True, corrected=0.4):
    return (
        lot, D0 + timedelta(days=n), f"i{n}", f"{lot}_s", harvest, ndvi, corrected,
        None if end is None else D0 + timedelta(days=end), age, gap, valid,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_dataset_and_size(spark):
    df = frame(spark, [row("a", 1), row("a", 2, valid=False), row("b", 1, harvest=None), row("c", 1), row("c", 2)])
    assert tuple(rp.dataset_size(rp.ml_dataset(df)).first()) == (3, 2)


def test_cycle_length_buckets(spark):
    ages = {"a": 299, "b": 300, "c": 349, "d": 350, "e": 400, "f": 401}
    df = frame(spark, [row(k, 1, age=v) for k, v in ages.items()] + [row("a", 2, age=10), row("z", 1, age=320, valid=False)])
    got = {r.bucket: (r.cycles, round(r.share, 3)) for r in rp.cycle_length_buckets(df).collect()}
    assert got == {"300-350": (2, 0.333), "350-400": (2, 0.333), "other": (2, 0.333)}


def test_renovation_report_limits_are_strict_and_missing_harvests_come_last(spark):
    rows = [
        row("a", 5, ndvi=0.19994, age=301), row("a", 3, ndvi=0.1, age=302), row("a", 1, ndvi=0.1, age=300),
        row("a", 2, ndvi=0.2, age=400), row("a", 2, ndvi=None, age=400), row("a", 2, ndvi=0.1, age=400, gap=True),
        row("a", 9, harvest=None, ndvi=0.1, age=500), row("b", 9, ndvi=0.1, age=500),
    ]
    got = [tuple(r) for r in rp.renovation_report(frame(spark, rows)).collect()]
    assert got == [
        ("a", "10/06/2021", D0 + timedelta(days=3), 301, 0.1),
        ("a", None, D0 + timedelta(days=9), 500, 0.1),
        ("b", "10/06/2021", D0 + timedelta(days=9), 500, 0.1),
    ]


def test_markers_are_of_two_kinds(spark):
    lots = spark.createDataFrame([("a",)], "lot_id string")
    rows = [
        row("a", 20, ndvi=0.1, age=201), row("a", 10, ndvi=0.15, age=201), row("a", 5, ndvi=0.1, age=200),
        row("a", 160, ndvi=0.1, age=300, end=160), row("a", 170, harvest=None, ndvi=0.1, age=300, end=170),
        row("a", 180, harvest=None, ndvi=0.1, age=300, end=None), row("b", 10, ndvi=0.1, age=300),
    ]
    got = {(r.kind, r.obs_date, r.ndvi_ref) for r in rp.renovation_markers(frame(spark, rows), lots).collect()}
    assert got == {
        ("before_harvest", D0 + timedelta(days=10), 0.15),
        ("detected", D0 + timedelta(days=170), 0.1),
    }


def test_growth_lots_history_and_curves(spark):
    rows = [
        row("a", 1, harvest="x"), row("a", 2, harvest="y"), row("b", 1, harvest="x"), row("b", 2, harvest="x"),
        row("c", 1, harvest="x"), row("c", 2, harvest="y", corrected=None), row("d", 1, harvest="x"), row("d", 2, harvest="y", age=None),
        row("a", 0, harvest=None), row("a", 9, harvest="x", ndvi=None),
    ]
    df = frame(spark, rows)
    lots = rp.growth_lots(df)
    assert [r.lot_id for r in lots.collect()] == ["a"]
    curves = rp.growth_curves(df, lots).collect()
    assert [(r.harvest, r.obs_date.day - 1) for r in curves][-1] == (None, 0) and len(curves) == 4
    history = rp.lot_history(df, lots).collect()
    assert [r.obs_date.day - 1 for r in history] == [0, 1, 2]
    with pytest.raises(Exception, match="cannot take 75 groups"):
        rp.growth_sample(df).collect()


def test_values_at_events(spark):
    df = frame(spark, [row("a", 3, ndvi=0.12346, age=310), row("a", 4, ndvi=0.1, age=311)])
    events = rp.renovated_harvests(df)
    got = rp.values_at_events(rp.renovated_history(df, events), events).first()
    assert (got.renovation_date, got.ndvi, got.age) == (D0 + timedelta(days=3), 0.1235, 310)


def test_traces_are_sorted_colored_and_keep_open_points(spark):
    rows = [
        row("a", 30, end=160, ndvi=0.33333), row("a", 10, end=160, age=None), row("a", 200, end=300),
        row("a", 400, end=None), row("b", 1, end=5),
    ]
    history = rp.lot_history(frame(spark, rows), spark.createDataFrame([("a",), ("b",)], "lot_id string"))
    got = {(r.lot_id, r.cycle_end): r for r in rp.history_traces(history).collect()}
    first = got[("a", D0 + timedelta(days=160))]
    assert first.dates == ["2021-01-11", "2021-01-31"] and first.ndvi == [0.5, 0.3333] and first.age == [None, 100]
    assert (first.color, got[("a", D0 + timedelta(days=300))].color, got[("a", None)].color) == (0, 1, None)
    assert len(got) == 4
    text = rp.traces_json(rp.history_traces(history), "cycle_end").where("lot_id = 'b'").first().trace
    assert json.loads(text)["ndvi"] == [0.5]


def test_colors_wrap_around(spark):
    df = frame(spark, [row("a", 1, harvest=f"h{k:02}", age=k) for k in range(12)])
    colors = {r.harvest: r.color for r in rp.growth_traces(df).collect()}
    assert colors["h09"] == 9 and colors["h10"] == 0


def test_a_trace_row_holds_a_calendar_year_and_counts_equal_points(spark):
    rows = [row("a", n, ndvi=n / 1000, age=n) for n in range(500)]
    df = frame(spark, rows).union(frame(spark, [row("a", 7, ndvi=0.7, age=7)]).crossJoin(spark.range(100_000)).drop("id"))
    series = {"dates": F.col("obs_date").cast("string"), "ndvi": F.col("ndvi_ref")}
    parts = rp.cycle_traces(df, "cycle_end", "obs_date", series, F.year("obs_date"), keep_open=True).collect()
    assert all({int(d[:4]) for d in r.dates} == {r.chunk} for r in parts) and len(parts) > 1
    points = {p[:2]: p[2] for r in parts for p in zip(r.dates, r.ndvi, r.copies)}
    assert len(points) == 501 and sorted(points.values())[-2:] == [1, 100_000]
    assert all(list(r.dates) == sorted(r.dates) for r in parts)


def test_other_feeds(spark):
    df = frame(spark, [row("a", n, harvest=h, age=n, ndvi=0.1 + n / 100) for n in range(4) for h in ("x", "y")])
    lots = spark.createDataFrame([("a",)], "lot_id string")
    curves = {r.harvest: r for r in rp.growth_traces(rp.growth_curves(df, lots)).collect()}
    assert curves["x"].age == [0, 1, 2, 3] and curves["y"].images == ["i0", "i1", "i2", "i3"] and curves["y"].color == 1
    events = spark.createDataFrame([("a",)], "lot_id string")
    traces = rp.renovated_traces(rp.renovated_history(df, events)).collect()
    assert sorted(r.harvest for r in traces) == ["x", "y"] and traces[0].ndvi == [0.1, 0.11, 0.12, 0.13]
