from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lotseries.operators import catalog, manifest

RING = "array<struct<x:double,y:double>>"
BOX = "xmin double, ymin double, xmax double, ymax double"
ALL = {"nir": "", "red": "", "swir16": ""}


def scenes(spark, rows):
    return spark.createDataFrame(
        [(i, p, t, c, a, *b) for i, p, t, c, a, b in rows],
        f"scene_id string, pos int, datetime string, cloud_cover double, assets map<string,string>, {BOX}",
    ).withColumn("datetime", F.to_timestamp("datetime"))


def test_search_takes_the_day_the_bounds_and_clouds_below_the_limit(spark):
    near, far = (0.0, 0.0, 5.0, 5.0), (50.0, 50.0, 60.0, 60.0)
    df = scenes(
        spark,
        [
            ("S2A_T1_a", 1, "2024-01-01 00:00:00", 99.9, ALL, near),
            ("S2A_T1_b", 2, "2024-01-01 23:59:59", 100.0, ALL, near),
            ("S2A_T1_c", 3, "2024-01-02 00:00:00", 1.0, ALL, near),
            ("S2A_T1_d", 4, "2024-01-01 12:00:00", None, ALL, near),
            ("S2A_T1_e", 5, "2024-01-01 12:00:00", 1.0, ALL, far),
            ("S2A_T1_f", 6, "2024-01-01 12:00:00", 1.0, ALL, (3.0, 3.0, 9.0, 9.0)),
        ],
    )
    lots = spark.createDataFrame([(date(2024, 1, 1), [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0)])], f"obs_date date, ring {RING}")
    assert {r.scene_id[-1] for r in catalog.search_scenes(df, lots).collect()} == {"a", "f"}


def test_best_scene_breaks_ties_by_arrival_and_treats_missing_clouds_as_full(spark):
    box = (0.0, 0.0, 1.0, 1.0)
    rows = [
        ("S2A_T1_a", 5, "2024-01-01 10:00:00", 20.0, ALL, box),
        ("S2A_T1_b", 4, "2024-01-01 10:00:00", 20.0, ALL, box),
        ("S2A_T1_c", 1, "2024-01-01 10:00:00", 30.0, ALL, box),
        ("S2A_T2_a", 2, "2024-01-01 10:00:00", None, ALL, box),
        ("S2A_T2_b", 3, "2024-01-01 10:00:00", 100.0, ALL, box),
        ("S2A_T3_a", 6, "2024-01-01 10:00:00", 1.0, {"nir": "", "red": ""}, box),
    ]
    dated = scenes(spark, rows).withColumn("obs_date", F.to_date("datetime"))
    best = catalog.best_scene_per_tile(dated)
    assert {(r.tile, r.scene_id, r.tile_order) for r in best.collect()} == {
        ("T1", "S2A_T1_b", 1), ("T2", "S2A_T2_a", 2), ("T3", "S2A_T3_a", 6),
    }
    assert {r.tile for r in catalog.with_required_assets(best).collect()} == {"T1", "T2"}


def test_every_touching_pair_is_found_once_and_the_first_tile_wins(spark, plan):
    lots = spark.createDataFrame(
        [(k, f"l{k}", [(x, 1.0), (x + 30.0, 1.0), (x + 30.0, 28.0), (x, 28.0)]) for k, x in enumerate((-40.0, 0.0, 15.0, 95.0, 300.0))],
        f"polygon_id int, lot_id string, ring {RING}",
    )
    boxes = [(x, y, x + 22.0, y + 22.0) for x in (-60.0, -20.0, 0.0, 20.0, 100.0) for y in (-10.0, 10.0)]
    tiles = spark.createDataFrame([(f"t{i}", 10 - i, *b) for i, b in enumerate(boxes)], f"scene_id string, tile_order int, {BOX}")
    expected = {
        (k, f"t{i}")
        for k, x in enumerate((-40.0, 0.0, 15.0, 95.0, 300.0))
        for i, b in enumerate(boxes)
        if x <= b[2] and x + 30 >= b[0] and 1 <= b[3] and 28 >= b[1]
    }
    for most in (1, 3, 1000):
        pairs = catalog.lots_touching_tiles(lots, tiles, most=most)
        got = [(r.polygon_id, r.scene_id) for r in pairs.collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    first = {r.polygon_id: r.scene_id for r in catalog.assign_first_tile(pairs, lots, tiles).collect()}
    assert first == {k: max((t for p, t in expected if p == k), key=lambda t: int(t[1:])) for k, _ in expected}
    assert "NestedLoop" not in plan(pairs) and "Cartesian" not in plan(pairs)


def test_a_dense_area_is_cut_and_a_sparse_one_is_not(spark, plan):
    """Nine tenths of the polygons lie in a hundredth of the area; some are large."""
    rows = spark.range(4000).selectExpr(
        "id AS polygon_id", "id % 10 > 0 AS dense", "pmod(hash(id, 1), 100000) / 100000 AS u", "pmod(hash(id, 2), 100000) / 100000 AS v"
    )
    x, y, w = "if(dense, 10 + u, u * 100)", "if(dense, 10 + v, v * 100)", "if(polygon_id % 500 = 3, 30, 0.004)"
    corner = lambda i, j: f"named_struct('x', {x} + {w} * {i}, 'y', {y} + {w} * {j})"
    lots = rows.selectExpr("polygon_id", f"array({corner(0, 0)}, {corner(1, 0)}, {corner(1, 1)}, {corner(0, 1)}) AS ring")
    tile = "named_struct('x', (id % 40) * 2.5, 'y', (id div 40) * 2.5)"
    tiles = spark.range(1600).selectExpr("concat('t', id) AS scene_id", "id AS tile_order", f"{tile}.x - 0.1 AS xmin", f"{tile}.y - 0.1 AS ymin", f"{tile}.x + 2.6 AS xmax", f"{tile}.y + 2.6 AS ymax")
    pairs = catalog.lots_touching_tiles(lots, tiles, most=60)
    got = sorted((r.polygon_id, r.scene_id, r.tile_order) for r in pairs.collect())
    plain = catalog.lots_touching_tiles(lots, tiles, most=10**9)
    assert got == sorted(map(tuple, plain.collect())) and len(got) == len(set(got)) > 4000

    box = {n: c for n, c in zip(catalog.BOX, catalog.polygon_bounds(F.array("ring")).values())}
    area = {"xmin": 0.0, "ymin": 0.0, "xmax": 130.0, "ymax": 130.0}
    left = lots.withColumns(box).withColumns(catalog._places(box, area))
    cut = catalog.crowded_cells(left.select("x0", "y0", "x1", "y1"), [], 60)
    spread = catalog.spread_over_cells(left, cut)
    cells = [r["count"] for r in spread.groupBy("level", "cell_x", "cell_y").count().collect()]
    assert len(cells) > 60 and max(cells) <= 3 * sorted(cells)[len(cells) // 2] + 60
    assert sum(cells) < 4000 * 1.6  # large boxes stay in large cells where little else is
    tasks = [r["count"] for r in spread.repartition(8, "level", "cell_x", "cell_y").groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 3 * sorted(tasks)[len(tasks) // 2]


def test_rings_pass_no_aggregate(spark, plan):
    lots = spark.createDataFrame([(1, "a", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], f"polygon_id int, lot_id string, ring {RING}")
    tiles = spark.createDataFrame([("t", 1, 0.0, 0.0, 9.0, 9.0)], f"scene_id string, tile_order int, {BOX}")
    assigned = catalog.assign_first_tile(catalog.lots_touching_tiles(lots, tiles), lots, tiles)
    assert "SortAggregate" not in plan(assigned)
    row = assigned.first()
    assert (row.lot_id, row.scene_id, row.xmax, len(row.ring)) == ("a", "t", 9.0, 3)


FILES = [
    "Reference/2021-raster/sugar/01-NDVI_20210105.tif",
    "Reference/2021-raster/old/01-NDVI_20210105.tif",
    "Reference/2021-raster/sugar/02-NDWI-11_20210105.tif",
    "Reference/2021-raster/sugar/04-MSI-11_20210105.tif",
    "STAC/2021/lots_20210105.shp",
    "STAC/2021/lots_20210105.dbf",
    "STAC/2021/lots_20210105.prj",
    "Reference/2021-raster/sugar/01-NDVI_20210110.tif",
    "Reference/2021-raster/sugar/04-MSI-11_20210110.TIF",
    "Reference/2021-raster/sugar/01-NDVI_123456789.tif",
    "Reference/2021-raster/sugar/01-NDVI_nodate.tif",
    "Reference/2021-raster/sugar/03-OTHER_20210105.tif",
    "Reference/2022-raster/sugar/readme.txt",
    "Reference/notes/x.txt",
    "STAC/2023/lots_20230101.shp",
]


def test_manifest_operators(spark):
    files = spark.createDataFrame([(p,) for p in FILES], "path string")
    assets = manifest.classify_assets(files)
    latest = {(r.kind, r.date): r.path for r in manifest.latest_asset(assets).collect()}
    assert latest[("ndvi", "20210105")] == FILES[0]  # sugar sorts after old
    assert ("ndvi", "12345678") in latest  # first run of eight digits
    assert ("msi11", "20210110") not in latest  # suffix is case-sensitive
    complete = manifest.complete_dates(assets).collect()
    assert [(r.date, r.ndvi, r.lots) for r in complete] == [("20210105", FILES[0], FILES[4])]
    assert sorted(r.date for r in manifest.skipped_dates(assets).collect()) == ["12345678", "20210110"]
    assert [r.year for r in manifest.discover_years(files, "Reference", "-raster").collect()] == ["2021", "2022"]
    assert [r.year for r in manifest.discover_years(files, "STAC").collect()] == ["2021", "2023"]
    assert [r.path for r in manifest.select_files(files, ".shp", limit=1).collect()] == [FILES[4]]
    assert [r.path for r in manifest.select_files(files, ".shp", years=["2023"]).collect()] == [FILES[14]]
    companions = {r.stem: r.extensions for r in manifest.companion_files(files).collect()}
    assert companions == {"lots_20210105": [".dbf", ".prj", ".shp"], "lots_20230101": [".shp"]}
    parents = {r.path: r.parent for r in manifest.describe_files(files).collect()}
    assert parents[FILES[0]] == "sugar"
    stems = [r.stem for r in manifest.distinct_stems(files).collect()]
    assert len(stems) == len(set(stems)) == 12
