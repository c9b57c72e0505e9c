"""Joins whose sides are larger than Spark takes them for."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotseries.operators import catalog, raster
from lotseries.operators.raster import PIXEL_KEY


def test_a_mask_is_never_broadcast(spark):
    """A few spans are many pixels: their size must not make the mask the broadcast side."""
    ring = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', 60D, 'y', 0D), named_struct('x', 60D, 'y', 60D), named_struct('x', 0D, 'y', 60D))"
    grid = {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": 1.0, "f": 0.0}
    polygons = spark.range(3).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("scene_id"), F.col("id").alias("polygon_id"),
        F.expr(f"array({ring})").alias("rings"), *[F.lit(v).alias(n) for n, v in grid.items()],
    )
    pixels = spark.range(300_000).select(
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("scene_id"),
        F.floor(F.col("id") / 3 % 100).cast("int").alias("row"), F.floor(F.col("id") / 300).cast("int").alias("col"),
        F.col("id").cast("double").alias("value"),
    )
    stats = raster.zonal_stats(pixels, polygons, ["value"])
    assert [r.value_count for r in stats.collect()] == [3600] * 3
    plan = stats._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert [line for line in final.splitlines() if "SortMergeJoin [scene_id" in line and PIXEL_KEY[1] in line and "BroadcastHash" not in line]


def _square(x: float, w: float) -> list:
    return [[(x, 0.0), (x + w, 0.0), (x + w, w), (x, w)]]


LOTS = "polygon_id long, lot_id string, rings array<array<struct<x: double, y: double>>>"
TILES = "scene_id string, tile_order long, xmin double, ymin double, xmax double, ymax double"


def test_rings_do_not_travel_to_the_cells(spark):
    """Rings are looked up afterwards, each by its own shape, even if polygons share their id or have none."""
    triangle = [[(9.0, 0.0), (11.0, 0.0), (9.0, 2.0)]]
    lots = spark.createDataFrame(
        [(1, "a", _square(1.0, 2.0)), (1, "a", _square(9.0, 2.0)), (None, "a", _square(9.0, 2.0)), (2, "b", triangle), (2, "b", triangle)],
        LOTS,
    )
    tiles = spark.createDataFrame([("t1", 1, 0.0, 0.0, 10.0, 10.0), ("t2", 2, 10.5, 1.5, 20.0, 10.0)], TILES)
    pairs = catalog.lots_touching_tiles(lots, tiles)
    found = sorted(pairs.collect(), key=str)
    want = [(1, "t1", 1), (1, "t1", 1), (1, "t2", 2), (None, "t1", 1), (None, "t2", 2), (2, "t1", 1), (2, "t1", 1)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "rings" not in [c for line in plan.splitlines() if "Join Inner" in line for c in line.split("#")[0].split()]
