"""Scene search and choice, and the assignment of polygons to tiles.

Catalogue rows: ``scene_id, pos, datetime, cloud_cover, assets (map), xmin,
ymin, xmax, ymax``; ``pos`` is the order of arrival. Lots: ``polygon_id,
lot_id``, ``ring`` or ``rings``, and, where lots differ by date, ``obs_date``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.functions.geometry import boxes_overlap, polygon_bounds, polygon_meets_box, polygon_of
from lotseries.sources.stored import stored

# Search limit (exclusive) and value of a missing cloud cover.
CLOUD_LIMIT = 100
# Assets a scene must have.
REQUIRED_ASSETS = ["nir", "red", "swir16"]

BOX = ["xmin", "ymin", "xmax", "ymax"]

# Spatial join: boxes of one day that a cell may hold before it is cut into four, and how often it is cut.
CELL_BOXES = 2_000
CELL_DEPTH = 20


def tile_id(scene_id: Column) -> Column:
    """Second ``_`` token of a scene id."""
    return F.split_part(scene_id, F.lit("_"), F.lit(2))


def total_bounds(lots: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bounding box of a set of polygons."""
    box = lots.select(*by, *[c.alias(n) for n, c in polygon_bounds(polygon_of(lots.columns)).items()])
    return box.groupBy(*by).agg(
        F.min("xmin").alias("xmin"),
        F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"),
        F.max("ymax").alias("ymax"),
    )


def search_scenes(catalogue: DataFrame, lots: DataFrame, cloud_limit: float = CLOUD_LIMIT) -> DataFrame:
    """Scenes of the day of a lot set that overlap its bounds and are not too cloudy.

    ``lots`` has ``obs_date``; its bounds are one row per day.
    """
    bounds = total_bounds(lots, ["obs_date"]).withColumnsRenamed({n: f"lots_{n}" for n in BOX})
    scenes = catalogue.where(F.col("cloud_cover") < cloud_limit).withColumn(
        "obs_date", F.to_date("datetime")
    )
    overlap = boxes_overlap(
        {n: F.col(n) for n in BOX}, {n: F.col(f"lots_{n}") for n in BOX}
    )
    return scenes.join(bounds, "obs_date").where(overlap).drop(*[f"lots_{n}" for n in BOX])


def best_scene_per_tile(scenes: DataFrame, by: Sequence[str] = ("obs_date",)) -> DataFrame:
    """Least cloudy scene of every tile; a tie keeps the first to arrive.

    ``tile_order`` is the arrival of the tile's first scene: tiles are used in that order.
    """
    cloud = F.coalesce(F.col("cloud_cover").cast("double"), F.lit(float(CLOUD_LIMIT)))
    tiles = scenes.withColumn("tile", tile_id(F.col("scene_id")))
    row = F.struct(*[c for c in tiles.columns if c not in (*by, "tile")])
    best = tiles.groupBy(*by, "tile").agg(
        F.min_by(row, F.struct(cloud, F.col("pos"))).alias("best"),
        F.min("pos").alias("tile_order"),
    )
    return best.select(*by, "tile", "tile_order", "best.*")


def with_required_assets(scenes: DataFrame, required: Sequence[str] = REQUIRED_ASSETS) -> DataFrame:
    """Drop scenes that lack an asset."""
    names = F.array(*[F.lit(a) for a in required])
    return scenes.where(F.size(F.array_except(names, F.map_keys("assets"))) == 0)


def _place(low: float, high: float, v: Column) -> Column:
    """Number of the finest cell that holds ``v``, of those that cut the range into equal parts."""
    cells = 2**CELL_DEPTH
    if not high > low:
        return F.lit(0)
    number = F.floor((v - F.lit(low)) / F.lit(high - low) * cells)
    return F.least(F.greatest(number, F.lit(0)), F.lit(cells - 1)).cast("int")


def _places(box: dict[str, Column], area: dict[str, float]) -> dict[str, Column]:
    """The finest cells at the corners of a box, as ``x0, y0, x1, y1``."""
    x, y = (area["xmin"], area["xmax"]), (area["ymin"], area["ymax"])
    return {
        "x0": _place(*x, box["xmin"]), "y0": _place(*y, box["ymin"]),
        "x1": _place(*x, box["xmax"]), "y1": _place(*y, box["ymax"]),
    }


def crowded_cells(places: DataFrame, by: Sequence[str], most: int) -> list[DataFrame]:
    """Cells to cut, level by level: those whose middle points are more than ``most`` on some day.

    ``places`` has ``x0, y0, x1, y1``. Cells below a cell that is not cut are not looked at.
    """
    # the count of the whole area needs no place, and mostly settles it
    if places.groupBy(*by).count().where(F.col("count") > most).isEmpty():
        return []
    middle = {f"m{a}": F.floor((F.col(f"{a}0") + F.col(f"{a}1")) / 2).cast("int") for a in "xy"}
    points = stored(places.select(*by, *[c.alias(n) for n, c in middle.items()]))
    cut: list[DataFrame] = []
    for level in range(CELL_DEPTH):
        cell = [F.shiftright(f"m{a}", CELL_DEPTH - level).alias(f"cell_{a}") for a in "xy"]
        counts = points.groupBy(*by, *cell).agg(F.count("*").alias("boxes"))
        full = counts.where(F.col("boxes") > most).select("cell_x", "cell_y").distinct()
        full = stored(full)
        if full.isEmpty():
            break
        cut.append(full)
        inside = full.select(F.col("cell_x").alias("in_x"), F.col("cell_y").alias("in_y"))
        points = points.join(inside, (cell[0] == F.col("in_x")) & (cell[1] == F.col("in_y")), "left_semi")
    return cut


def spread_over_cells(boxes: DataFrame, cut: Sequence[DataFrame]) -> DataFrame:
    """Boxes (``x0, y0, x1, y1``) once for each uncut cell that they meet: ``level, cell_x, cell_y``.

    All start in the cell of the whole area; those in a cell that is cut go to its quarters.
    """
    # zero, but no constants: those would drop out of the join keys
    whole = F.shiftright("x0", CELL_DEPTH)
    spread = boxes.withColumns({"level": whole, "cell_x": whole, "cell_y": F.shiftright("y0", CELL_DEPTH)})
    for level, full in enumerate(cut):
        finer = CELL_DEPTH - level - 1

        def halves(a: str) -> Column:
            low = F.greatest(F.shiftright(f"{a}0", finer), F.col(f"cell_{a}") * 2)
            high = F.least(F.shiftright(f"{a}1", finer), F.col(f"cell_{a}") * 2 + 1)
            return F.when(F.col("cut"), F.sequence(low, high)).otherwise(F.array(f"cell_{a}"))

        marked = full.withColumns({"level": F.lit(level), "cut": F.lit(True)})
        found = spread.join(marked, ["level", "cell_x", "cell_y"], "left").withColumn("cut", F.coalesce("cut", F.lit(False)))
        # one after the other: each reads the cell it replaces
        spread = (
            found.withColumns({"xs": halves("x"), "ys": halves("y")})
            .withColumn("cell_x", F.explode("xs"))
            .withColumn("cell_y", F.explode("ys"))
            .withColumn("level", F.col("level") + F.col("cut").cast("int"))
            .drop("xs", "ys", "cut")
        )
    return spread


def lots_touching_tiles(
    lots: DataFrame, tiles: DataFrame, by: Sequence[str] = (), most: int = CELL_BOXES
) -> DataFrame:
    """Pairs of a polygon and a tile extent that share at least a point: ``polygon_id, scene_id, tile_order``.

    Both sides are spread over the cells of a quadtree and joined on the cell. The tree is cut by
    what it holds: a cell with the middles of more than ``most`` boxes of a day becomes four, so no cell,
    however dense its area, is too much for one task, and boxes in sparse areas stay in one large cell. A pair that shares several cells is kept only in the first one of its common box, so no
    de-duplication is needed.

    Only boxes travel to the cells. Polygons cut by a tile's edge look their rings up afterwards, each
    different polygon being held once, however many days it has.
    """
    lot_box, tile_box = {n: F.col(f"lot_{n}") for n in BOX}, {n: F.col(n) for n in BOX}
    rings = polygon_of(lots.columns)
    bounds = {f"lot_{n}": c for n, c in polygon_bounds(rings).items()}
    shape = F.xxhash64(rings).alias("shape")
    left = lots.select(*by, "polygon_id", shape, *[c.alias(n) for n, c in bounds.items()])
    shapes = lots.select(F.col("polygon_id").alias("_polygon"), shape.alias("_shape"), rings.alias("rings")).distinct()
    ends = {"min": F.min, "max": F.max}
    whole = left.agg(*[ends[n[1:]](f"lot_{n}").alias(n) for n in BOX]).first().asDict()  # one row
    area = {n: 0.0 if v is None else float(v) for n, v in whole.items()}
    left = left.withColumns(_places(lot_box, area))
    right = tiles.select(*by, "scene_id", "tile_order", *BOX).withColumns(_places(tile_box, area))
    corners = ["x0", "y0", "x1", "y1"]
    cut = crowded_cells(left.select(*by, *corners).union(right.select(*by, *corners)), by, most)

    far = ["x1", "y1"]
    spread_tiles = spread_over_cells(right, cut).drop(*far).withColumnsRenamed({n: f"tile_{n}" for n in corners})
    pairs = spread_over_cells(left, cut).drop(*far).join(spread_tiles, [*by, "level", "cell_x", "cell_y"])
    first = [
        F.expr(f"shiftright(greatest({a}0, tile_{a}0), {CELL_DEPTH} - level)") == F.col(f"cell_{a}") for a in "xy"
    ]
    within = (
        (lot_box["xmin"] >= tile_box["xmin"]) & (lot_box["xmax"] <= tile_box["xmax"])
        & (lot_box["ymin"] >= tile_box["ymin"]) & (lot_box["ymax"] <= tile_box["ymax"])
    )
    near = pairs.where(boxes_overlap(lot_box, tile_box) & first[0] & first[1]).select(
        *by, "polygon_id", "shape", "scene_id", "tile_order", within.alias("within"),
        *[F.when(~within, c).alias(n) for n, c in tile_box.items()],
    )
    same = F.col("polygon_id").eqNullSafe(F.col("_polygon")) & (F.col("shape") == F.col("_shape"))
    return (
        near.join(shapes, same & ~F.col("within"), "left")
        .where(F.col("within") | polygon_meets_box(F.col("rings"), tile_box))
        .select(*by, "polygon_id", "scene_id", "tile_order")
    )


def assign_first_tile(pairs: DataFrame, lots: DataFrame, tiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Use every polygon only in the first tile that touches it; rows of ``lots`` with the columns of that tile.

    A polygon cut by a tile edge is therefore measured in part. Only the order of the tile goes
    through the aggregate; rings and tiles are looked up for the pairs that are left. ``tile_order``
    is unique among the tiles of a day.
    """
    first = pairs.groupBy(*by, "polygon_id").agg(F.min("tile_order").alias("tile_order"))
    return lots.join(first, [*by, "polygon_id"]).join(tiles, [*by, "tile_order"])
