from __future__ import annotations

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotseries.functions import geometry as g
from lotseries.functions import indices as ix
from lotseries.operators import raster

RING = "array<struct<x:double,y:double>>"
TRANSFORM = "a double, b double, c double, d double, e double, f double"
SQUARE = [(1.0, 1.0), (5.0, 1.0), (5.0, 5.0), (1.0, 5.0)]
TRIANGLE = [(0.2, 0.1), (7.8, 0.3), (3.9, 7.7)]
CONCAVE = [(0.3, 0.3), (7.7, 0.3), (7.7, 7.7), (4.1, 2.2), (0.3, 7.7), (0.3, 0.3)]
TINY = [(2.6, 2.6), (2.9, 2.6), (2.9, 2.9)]


def inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


@pytest.fixture(scope="module")
def grid():
    values = np.arange(64, dtype=float).reshape(8, 8) / 7 - 3
    values[3, 3] = np.nan
    return values


def pixel_frame(spark, values, scene="s"):
    rows = [
        (scene, r, c, None if np.isnan(v) and (r + c) % 4 else float(v))
        for (r, c), v in np.ndenumerate(values)
    ]
    return spark.createDataFrame(rows, "scene_id string, row int, col int, value double")


def polygon_frame(spark, rings, transform=(1.0, 0.0, 0.0, 0.0, 1.0, 0.0)):
    rows = [("s", k, lot, ring, *transform) for k, (lot, ring) in enumerate(rings)]
    return spark.createDataFrame(rows, f"scene_id string, polygon_id int, lot_id string, ring {RING}, {TRANSFORM}")


def expected(values, ring, transform=(1.0, 0.0, 0.0, 0.0, 1.0, 0.0)):
    a, b, c, d, e, f = transform
    hit = [
        v
        for (r, k), v in np.ndenumerate(values)
        if not np.isnan(v)
        and inside(a * (k + 0.5) + b * (r + 0.5) + c, d * (k + 0.5) + e * (r + 0.5) + f, ring)
    ]
    return np.array(hit)


def check(row, values):
    assert row.value_count == len(values)
    if len(values):
        for name, want in (("mean", values.mean()), ("max", values.max()), ("min", values.min()), ("std", values.std())):
            assert math.isclose(row[f"value_{name}"], want, abs_tol=1e-12)
    else:
        assert row.value_mean is None and row.value_std is None


def test_zonal_statistics_equal_a_test_of_every_pixel(spark, grid):
    rings = [("a", SQUARE), ("a", TRIANGLE), ("b", CONCAVE), ("c", TINY), ("d", [(90.0, 90.0), (99.0, 90.0), (95.0, 99.0)])]
    rows = raster.zonal_stats(pixel_frame(spark, grid), polygon_frame(spark, rings), ["value"]).collect()
    assert len(rows) == 5
    for row in rows:
        check(row, expected(grid, rings[row.polygon_id][1]))


def test_zonal_statistics_on_a_rotated_grid(spark, grid):
    t = (0.9, 0.3, 10.0, 0.2, -1.1, 20.0)
    ring = [(10.7, 17.3), (16.9, 19.2), (17.4, 13.1), (13.2, 11.4)]
    row = raster.zonal_stats(pixel_frame(spark, grid), polygon_frame(spark, [("a", ring)], t), ["value"]).first()
    want = expected(grid, ring, t)
    assert len(want) > 10
    check(row, want)


def test_random_polygons(spark, grid):
    rng = np.random.default_rng(5)
    rings = [(f"l{k}", [tuple(map(float, p)) for p in rng.uniform(-2, 10, (rng.integers(3, 9), 2))]) for k in range(40)]
    rows = raster.zonal_stats(pixel_frame(spark, grid), polygon_frame(spark, rings), ["value"]).collect()
    for row in rows:
        check(row, expected(grid, rings[row.polygon_id][1]))


def test_pooling_equals_direct_statistics(spark):
    rng = np.random.default_rng(3)
    data = [(f"l{i % 3}", int(i % 11), float(v)) for i, v in enumerate(rng.normal(5, 2, 400))]
    df = spark.createDataFrame(data, "lot_id string, polygon_id int, v double")
    parts = df.groupBy("lot_id", "polygon_id").agg(
        F.count("v").alias("v_count"), F.avg("v").alias("v_mean"), F.max("v").alias("v_max"),
        F.min("v").alias("v_min"), F.stddev_pop("v").alias("v_std"),
    )
    empty = spark.createDataFrame([("l0", 99, 0, None, None, None, None), ("none", 1, 0, None, None, None, None)], parts.schema)
    out = {r.lot_id: r for r in raster.finalize_stats(raster.pool_stats(parts.union(empty), ["lot_id"], ["v"]), ["v"], 8).collect()}
    for lot in ("l0", "l1", "l2"):
        v = np.array([x for name, _, x in data if name == lot])
        want = (v.mean(), v.max(), v.min(), v.std())
        assert np.allclose((out[lot].v_mean, out[lot].v_max, out[lot].v_min, out[lot].v_std), want, atol=1e-8)
    assert out["none"].v_mean is None and out["none"].v_std is None


def test_bilinear_resampling_clamps_at_the_edges(spark):
    rng = np.random.default_rng(1)
    coarse = rng.normal(size=(4, 4))
    fine = [("s", r, c, 0.5, 0.0, 0.0, 0.0, 0.5, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0) for r in range(8) for c in range(8)]
    names = [f"{p}_{n} double" for p in ("fine", "coarse") for n in "abcdef"]
    targets = spark.createDataFrame(fine, f"scene_id string, row int, col int, {', '.join(names)}")
    got = raster.resample_bilinear(targets, pixel_frame(spark, coarse)).collect()
    assert len(got) == 64
    for r in got:
        u, v = np.clip((r.col + 0.5) / 2 - 0.5, 0, 3), np.clip((r.row + 0.5) / 2 - 0.5, 0, 3)
        x0, y0 = int(u), int(v)
        x1, y1, du, dv = min(x0 + 1, 3), min(y0 + 1, 3), u - int(u), v - int(v)
        want = (coarse[y0, x0] * (1 - du) + coarse[y0, x1] * du) * (1 - dv) + (
            coarse[y1, x0] * (1 - du) + coarse[y1, x1] * du
        ) * dv
        assert math.isclose(r.value, want, abs_tol=1e-12)


def test_clip_keeps_pixel_centres_in_the_bounds(spark, grid):
    bounds = spark.createDataFrame([("s", 1.5, 2.0, 4.4, 6.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0)], f"scene_id string, xmin double, ymin double, xmax double, ymax double, {TRANSFORM}")
    got = {(r.row, r.col) for r in raster.clip_pixels(pixel_frame(spark, grid), bounds).collect()}
    assert got == {(r, c) for r in (2, 3, 4, 5) for c in (1, 2, 3)}


def test_world_files(spark):
    own = (5.0, 0.0, 1.0, 0.0, -5.0, 2.0)
    world = ["2\n0.1\n 0.2 \n-2\n\n100\n200\n", "1\n2\n3\n4\n5", None, "2\nx\n0\n-2\n0\n0", "1\n0\n0\n1\n0\n0\n7"]
    rows = [(f"s{i}", *own, w) for i, w in enumerate(world)]
    df = spark.createDataFrame(rows, f"scene_id string, {TRANSFORM}, world_file string")
    got = {r.scene_id: tuple(r)[1:] for r in raster.effective_transforms(df).collect()}
    assert got == {"s0": (2.0, 0.2, 100.0, 0.1, -2.0, 200.0), "s1": own, "s2": own}


def test_transforms_are_inverse(spark):
    t = {n: F.lit(v) for n, v in zip("abcdef", (0.9, 0.3, 10.0, 0.2, -1.1, 20.0))}
    x, y = g.pixel_center(F.lit(3), F.lit(5), t)
    col, row = g.to_pixel(x, y, t)
    shifted = g.window_transform(t, F.lit(2), F.lit(4))
    x2, y2 = g.pixel_center(F.lit(1), F.lit(1), shifted)
    got = spark.range(1).select(col, row, x - x2, y - y2).first()
    assert np.allclose(tuple(got), (3.5, 5.5, 0.0, 0.0))


def test_polygon_and_box(spark):
    boxes = {
        "cut by an edge": (4.0, 4.0, 9.0, 9.0, True),
        "inside the polygon": (2.0, 2.0, 3.0, 3.0, True),
        "holds the polygon": (-9.0, -9.0, 9.0, 9.0, True),
        "touches a corner": (5.0, 5.0, 6.0, 6.0, True),
        "apart": (5.1, 5.1, 6.0, 6.0, False),
        "crossed without a vertex": (2.0, -3.0, 3.0, 9.0, True),
    }
    df = spark.createDataFrame([(n, SQUARE, *b[:4]) for n, b in boxes.items()], f"n string, ring {RING}, xmin double, ymin double, xmax double, ymax double")
    box = {k: F.col(k) for k in ("xmin", "ymin", "xmax", "ymax")}
    got = {r[0]: r[1] for r in df.select("n", g.ring_meets_box(F.col("ring"), box)).collect()}
    assert got == {n: b[4] for n, b in boxes.items()}
    notch = spark.createDataFrame([(CONCAVE, 3.6, 5.0, 4.6, 7.0)], f"ring {RING}, xmin double, ymin double, xmax double, ymax double")
    assert notch.select(g.ring_meets_box(F.col("ring"), box)).first()[0] is False
    points = spark.createDataFrame([(CONCAVE, 1.0, 1.0), (CONCAVE, 4.1, 5.0)], f"ring {RING}, x double, y double")
    assert [r[0] for r in points.select(g.point_in_ring(F.col("x"), F.col("y"), F.col("ring"))).collect()] == [True, False]


def test_index_algebra_needs_positive_bands(spark):
    df = spark.createDataFrame([(3, 1), (0, 1), (1, 0), (-1, 2), (None, 1)], "a int, b int")
    got = df.select(ix.normalized_difference(F.col("a"), F.col("b")), ix.band_ratio(F.col("b"), F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(0.5, 1 / 3)] + [(None, None)] * 4


def test_scene_extraction_measures_a_polygon_in_its_first_tile_only(spark):
    """Two tiles side by side, one polygon across both, one lot made of two polygons."""
    from lotseries.plans.extraction import extract_scene_indices
    from lotseries.schema import INDEX_COLUMNS

    day = date(2024, 1, 1)
    ring = lambda x0, x1: [(x0, 0.6), (x1, 0.6), (x1, 3.4), (x0, 3.4)]
    lots = spark.createDataFrame(
        [(day, 1, "across", ring(2.6, 6.4)), (day, 2, "two", ring(0.4, 1.6)), (day, 3, "two", ring(6.4, 7.6))],
        f"obs_date date, polygon_id int, lot_id string, ring {RING}",
    )
    scenes = [("S2A_L_1", 1, 30.0, 0.0), ("S2A_R_1", 2, 10.0, 4.0), ("S2A_L_2", 3, 20.0, 0.0), ("S2A_R_2", 4, None, 4.0)]
    catalogue = spark.createDataFrame(
        [(s, p, f"2024-01-01 1{p}:00:00", cl, {"nir": "", "red": "", "swir16": ""}, x, 0.0, x + 4.0, 4.0) for s, p, cl, x in scenes],
        "scene_id string, pos int, datetime string, cloud_cover double, assets map<string,string>, xmin double, ymin double, xmax double, ymax double",
    ).withColumn("datetime", F.to_timestamp("datetime"))
    pixels, transforms = [], []
    for s, _, _, x in scenes:
        for band, size in (("nir", 1.0), ("red", 1.0), ("swir16", 2.0)):
            transforms.append((s, band, size, 0.0, x, 0.0, size, 0.0))
            n = int(4 / size)
            base = {"nir": 6.0, "red": 2.0, "swir16": 3.0}[band] + (1.0 if "R" in s else 0.0)
            pixels += [(s, band, r, c, base) for r in range(n) for c in range(n)]
    out = extract_scene_indices(
        lots,
        catalogue,
        spark.createDataFrame(pixels, "scene_id string, band string, row int, col int, value double"),
        spark.createDataFrame(transforms, f"scene_id string, band string, {TRANSFORM}"),
    )
    assert out.columns == INDEX_COLUMNS
    rows = {r.lot_id: r for r in out.collect()}
    # tile L is met first; the least cloudy scene of L is the second one
    assert rows["across"].image_id == "S2A_L_2" and rows["two"].image_id == "S2A_L_2"
    assert rows["across"].ndvi_mean == 0.5 and rows["across"].msi11_mean == 0.5
    left, right = 0.5, 4 / 10
    assert rows["two"].ndvi_mean == round((left + right) / 2, 4) and rows["two"].ndvi_max == 0.5
    assert rows["two"].obs_date == "2024-01-01"


HOLED = [[(0.3, 0.2), (7.6, 0.4), (7.1, 7.7), (0.4, 7.2)], [(2.2, 2.1), (5.3, 2.4), (4.9, 5.6), (2.4, 5.1)], [(3.1, 3.2), (4.2, 3.3), (4.1, 4.4)]]
PARTS = [[(0.1, 0.2), (2.7, 0.3), (2.4, 3.1)], [(4.2, 4.1), (7.9, 4.4), (7.3, 7.8), (4.4, 7.2)], [(5.1, 5.2), (6.4, 5.3), (6.2, 6.6)]]


def inside_any(x, y, rings):
    return sum(inside(x, y, ring) for ring in rings) % 2 == 1


def rings_frame(spark, polygons, scene="s"):
    rows = [(scene, k, f"l{k}", rings, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0) for k, rings in enumerate(polygons)]
    return spark.createDataFrame(rows, f"scene_id string, polygon_id int, lot_id string, rings array<{RING}>, {TRANSFORM}")


def test_holes_and_parts_equal_a_test_of_every_pixel(spark, grid):
    rng = np.random.default_rng(9)
    wild = [[[tuple(map(float, p)) for p in rng.uniform(-1, 9, (rng.integers(3, 7), 2))] for _ in range(3)] for _ in range(12)]
    polygons = [HOLED, PARTS, [SQUARE], *wild, []]
    rows = raster.zonal_stats(pixel_frame(spark, grid), rings_frame(spark, polygons), ["value"]).collect()
    assert len(rows) == len(polygons)
    for row in rows:
        rings = polygons[row.polygon_id]
        hit = [v for (r, c), v in np.ndenumerate(grid) if not np.isnan(v) and inside_any(c + 0.5, r + 0.5, rings)]
        check(row, np.array(hit))
    covered = raster.polygon_mask(rings_frame(spark, [HOLED])).collect()
    assert (4, 2) not in {(r.row, r.col) for r in covered}  # in the hole
    assert (3, 3) in {(r.row, r.col) for r in covered}  # on the island in it


def test_polygons_with_holes_and_boxes(spark):
    boxes = {"in the hole": (2.6, 2.6, 2.9, 2.9, False), "on the island": (3.4, 3.4, 3.5, 3.5, True), "across the hole's edge": (2.0, 3.0, 2.6, 3.2, True)}
    df = spark.createDataFrame([(n, HOLED, *b[:4]) for n, b in boxes.items()], f"n string, rings array<{RING}>, xmin double, ymin double, xmax double, ymax double")
    box = {k: F.col(k) for k in ("xmin", "ymin", "xmax", "ymax")}
    got = {r[0]: r[1] for r in df.select("n", g.polygon_meets_box(F.col("rings"), box)).collect()}
    assert got == {n: b[4] for n, b in boxes.items()}
    bounds = df.select(*[c.alias(n) for n, c in g.polygon_bounds(F.col("rings")).items()]).first()
    assert tuple(bounds) == (0.3, 0.2, 7.6, 7.7)


def scans(df):
    """Rows that the scans of the last stage of a plan have read."""
    df.collect()
    result = df._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().apply(0)
    leaves = result.plan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return [leaf.metrics().apply("numOutputRows").value() for leaf in found if leaf.metrics().contains("numFiles")]


def test_window_read_opens_only_the_blocks_it_meets(spark, tmp_path, plan):
    from lotseries.sources.pixel_store import read_pixels, write_pixels

    pixels = spark.range(0, 2 * 64 * 64).selectExpr(
        "concat('s', id div 4096) AS scene_id", "cast(id % 4096 div 64 AS int) AS row", "cast(id % 64 AS int) AS col", "id * 1.0D AS value"
    )
    path = str(tmp_path / "pixels")
    write_pixels(pixels, path, 16)
    bounds = spark.createDataFrame(
        [("s0", "a", 17.2, 20.0, 30.0, 30.9, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0), ("s1", "b", 0.0, 0.0, 17.0, 3.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0),
         ("s1", "c", 900.0, 900.0, 901.0, 901.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0)],
        f"scene_id string, lot_id string, xmin double, ymin double, xmax double, ymax double, {TRANSFORM}",
    )
    store = read_pixels(spark, path, pixels.schema)
    clipped = raster.clip_pixels(store, bounds, block=16, keep=["lot_id"])
    plain = raster.clip_pixels(pixels, bounds, keep=["lot_id"])
    rows = sorted(map(tuple, clipped.collect()))
    assert rows == sorted(map(tuple, plain.collect())) and len(rows) == 13 * 11 + 17 * 3
    assert "dynamicpruning" in plan(clipped) and "Exchange hashpartitioning" not in plan(clipped)
    assert scans(clipped) == [3 * 256]  # one block of s0, two of s1, of 32
    write_pixels(pixels.where("scene_id = 's0' and row < 16 and col < 16").withColumn("value", F.lit(-1.0)), path, 16)
    again = read_pixels(spark, path, pixels.schema)
    assert again.count() == 8192 and again.where("value = -1").count() == 256  # other blocks stay


def test_dates_with_a_failed_input_are_left_out(spark):
    from lotseries.plans.extraction import extract_raster_indices

    names = {"ndvi": "01-NDVI_", "ndwi11": "02-NDWI-11_", "msi11": "04-MSI-11_"}
    dates = ["20240101", "20240102", "20240103", "20240104", "20240105", "20240106"]
    tif = lambda d, i: f"R/2024-raster/sugar/{names[i]}{d}.tif"
    paths = [tif(d, i) for d in dates for i in names] + [f"S/2024/lots_{d}.shp" for d in dates]
    pixels = [(tif(d, i), r, c, 0.5) for d in dates for i in names for r in range(4) for c in range(4)]
    pixels = [p for p in pixels if p[0] != tif("20240102", "ndwi11")]  # without pixels
    own, flat = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0), (1.0, 1.0, 0.0, 1.0, 1.0, 0.0)
    world = {tif("20240103", "msi11"): "1\n0\nx\n1\n0\n0", tif("20240106", "msi11"): "1\n2\n3"}  # broken; short, so unused
    transforms = [(tif(d, i), *(flat if (d, i) == ("20240105", "ndvi") else own), world.get(tif(d, i))) for d in dates for i in names]
    ring = [(0.1, 0.1), (2.9, 0.1), (2.9, 2.9), (0.1, 2.9)]
    lots = [(f"lots_{d}", 1, "lot", [ring]) for d in dates if d != "20240104"]  # a lot file without lots
    out = extract_raster_indices(
        spark.createDataFrame([(p,) for p in paths], "path string"),
        spark.createDataFrame(lots, f"stem string, polygon_id int, lot_id string, rings array<{RING}>"),
        spark.createDataFrame(pixels, "scene_id string, row int, col int, value double"),
        spark.createDataFrame(transforms, f"scene_id string, {TRANSFORM}, world_file string"),
    )
    assert sorted((r.obs_date, r.ndvi_mean) for r in out.collect()) == [("2024-01-01", 0.5), ("2024-01-06", 0.5)]


def test_a_scene_that_cannot_be_read_is_passed_over(spark):
    from lotseries.plans.extraction import extract_scene_indices, readable_scenes

    day, box = date(2024, 1, 1), [(0.6, 0.6), (3.4, 0.6), (3.4, 3.4), (0.6, 3.4)]
    lots = spark.createDataFrame([(day, 1, "lot", box)], f"obs_date date, polygon_id int, lot_id string, ring {RING}")
    scenes = [f"S2A_T{k}_x" for k in range(4)]
    catalogue = spark.createDataFrame(
        [(s, p, "2024-01-01 10:00:00", 1.0, {"nir": "", "red": "", "swir16": ""}, 0.0, 0.0, 4.0, 4.0) for p, s in enumerate(scenes)],
        "scene_id string, pos int, datetime string, cloud_cover double, assets map<string,string>, xmin double, ymin double, xmax double, ymax double",
    ).withColumn("datetime", F.to_timestamp("datetime"))
    bands = {"nir": (1.0, 6.0), "red": (1.0, 2.0), "swir16": (2.0, 3.0)}
    pixels = [(s, b, r, c, v) for s in scenes for b, (size, v) in bands.items() for r in range(int(4 / size)) for c in range(int(4 / size))]
    pixels = [p for p in pixels if p[:2] != (scenes[0], "swir16")]  # a band without pixels
    grids = [(s, b, size, 0.0, 0.0, 0.0, 0.0 if (s, b) == (scenes[1], "red") else size, 0.0) for s in scenes for b, (size, _) in bands.items()]
    grids = [t for t in grids if t[:2] != (scenes[2], "nir")]  # a band without a transform
    px = spark.createDataFrame(pixels, "scene_id string, band string, row int, col int, value double")
    tf = spark.createDataFrame(grids, f"scene_id string, band string, {TRANSFORM}")
    assert [r.scene_id for r in readable_scenes(px, tf).collect()] == [scenes[3]]
    (row,) = extract_scene_indices(lots, catalogue, px, tf).collect()
    assert (row.image_id, row.ndvi_mean, row.msi11_mean) == (scenes[3], 0.5, 0.5)
