"""The feeds as documents: written by many tasks, read back as one."""

from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lotseries.operators import feeds

DAY = date(2024, 1, 1)


@pytest.fixture
def history(spark):
    rows = []
    for lot, n in (("hot", 900), ('b"2\\', 7), ("c", 1), ("ä\n", 2)):
        for i in range(n):
            end = None if i % 10 == 9 else DAY + timedelta(days=100 + 300 * (i % 4))
            age = None if i % 13 == 5 else i % 40
            rows.append((lot, DAY + timedelta(days=i // 2), (i * 37 % 101) / 100 - 0.3, age, end))
    rows.append(rows[0])  # a repeated row is listed twice
    schema = "lot_id string, obs_date date, ndvi_ref double, crop_age_days int, cycle_end date"
    return spark.createDataFrame(rows, schema), rows


def document(df, path):
    """Lots of a written feed: its files in order of their names, put one behind the other."""
    df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    feeds.write_feed(df, str(path))
    df.sparkSession.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(p for p in path.iterdir() if p.name.startswith("part-"))
    text = "".join(p.read_text() for p in files)
    return [json.loads(line) for line in text.split("\n") if line.strip()], len(files)


def test_lot_feed_is_one_document(spark, history, tmp_path):
    df, rows = history
    markers = [("hot", DAY + timedelta(days=k), 0.1, None if k else 5, DAY + timedelta(days=400), "detected") for k in range(3)]
    markers.append(("unknown", DAY, 0.1, 1, DAY, "detected"))
    events = spark.createDataFrame(markers, "lot_id string, obs_date date, ndvi_ref double, crop_age_days int, cycle_end date, kind string")
    lots, files = document(feeds.lot_feed(df, events), tmp_path / "feed")
    assert files > 1  # the hot lot goes on from file to file
    assert [lot["label"] for lot in lots] == sorted({r[0] for r in rows})
    for lot in lots:
        own = [r for r in rows if r[0] == lot["label"]]
        ends = sorted({r[4] for r in own if r[4]}) + [None] * any(r[4] is None for r in own)
        assert [t["label"] for t in lot["traces"]] == [str(e) if e else "sin cierre" for e in ends]
        assert [t["color"] for t in lot["traces"]] == [i % 15 if e else None for i, e in enumerate(ends)]
        for end, trace in zip(ends, lot["traces"]):
            points = sorted((r for r in own if r[4] == end), key=lambda r: (r[1], r[2], r[3] is not None, r[3]))
            assert trace["fecha"] == [str(r[1]) for r in points]
            assert trace["ndvi"] == [round(r[2], 4) for r in points]
            assert trace["edad"] == [r[3] for r in points]
    hot = next(lot for lot in lots if lot["label"] == "hot")
    assert [(e["fecha"], e["edad"], e["cierre_ciclo"]) for e in hot["renovations"]] == [
        ("2024-01-01", 5, "2025-02-04"), ("2024-01-02", None, "2025-02-04"), ("2024-01-03", None, "2025-02-04")
    ]
    assert all(lot["renovations"] == [] for lot in lots if lot["label"] != "hot")


def test_growth_feed_leaves_points_without_a_harvest_out(spark, history, tmp_path):
    df, rows = history
    curves = df.where("crop_age_days is not null").select(
        "lot_id", "crop_age_days", (F.col("ndvi_ref") + 0.1).alias("ndvi_corrected"),
        F.when(F.col("crop_age_days") % 3 > 0, F.col("ndvi_ref")).alias("ndvi_ref"),
        F.col("cycle_end").cast("string").alias("harvest"), "obs_date", F.concat(F.lit("9"), "lot_id").alias("image_id"),
    )
    lots, _ = document(feeds.growth_feed(curves), tmp_path / "feed")
    for lot in lots:
        own = [r for r in rows if r[0] == lot["label"] and r[3] is not None and r[4]]
        assert [t["label"] for t in lot["traces"]] == sorted({str(r[4]) for r in own})
        for trace in lot["traces"]:
            ages = [r[3] for r in own if str(r[4]) == trace["label"]]
            assert trace["edad"] == sorted(ages) and len(trace["stac"]) == len(trace["id_img"]) == len(ages)
            assert all((r is None) == (a % 3 == 0) for a, r in zip(trace["edad"], trace["ref"]))
    assert "renovations" not in lots[0]


def test_no_task_holds_a_lot(spark, history, plan):
    df, _ = history
    text = plan(feeds.ordered(feeds.growth_feed(df.withColumns({"ndvi_corrected": F.lit(0.1), "harvest": F.lit("x"), "image_id": F.lit("i")}))))
    assert "collect_list" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_an_empty_feed(spark, history, tmp_path):
    df, _ = history
    empty = df.limit(0)
    lots, _ = document(feeds.lot_feed(empty, empty.withColumn("kind", F.lit("x"))), tmp_path / "feed")
    assert lots == []
