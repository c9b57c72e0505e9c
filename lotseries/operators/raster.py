"""Zonal statistics over pixel tables.

Pixels: ``scene_id, row, col`` and value columns. Polygons: ``scene_id,
polygon_id``, ``ring`` or ``rings`` (parts and holes), and the six transform columns
of the scene's grid.

A polygon is turned into the pixels whose centre it covers, and these are joined with
the pixel table on ``(scene_id, row, col)``. That is a plain equi-join on a fine key: no
pixel is tested against a polygon that does not cover it, and a large polygon or a
crowded scene spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotseries.functions.geometry import (
    TRANSFORM,
    crosses_line,
    crossing_x,
    pixel_center,
    polygon_bounds,
    polygon_edges,
    polygon_of,
    to_pixel,
    usable_transform,
    world_file,
    world_file_broken,
)
from lotseries.schema import INDICES, STATISTICS
from lotseries.sources.stored import stored

PIXEL_KEY = ["scene_id", "row", "col"]
BLOCK_KEY = "block"
# Pixels of the polygons' boxes that one task unfolds, about.
PIXELS_A_TASK = 250_000


def transform_columns(prefix: str = "") -> dict[str, Column]:
    return {n: F.col(f"{prefix}{n}") for n in TRANSFORM}


def polygon_mask(polygons: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pixels whose centre lies in a polygon: ``scene_id, polygon_id, row, col`` and the columns ``keep`` of its row.

    Scan lines over an edge table: every edge goes to the pixel rows whose centre line it crosses, and
    along each row the area between an odd crossing and the next one is inside. Rings need not be told
    apart, so holes and parts come for free; the work is rows + edges, and no row holds a whole polygon.
    One huge polygon spreads by its rows, over as many tasks as the polygons' boxes have pixels for.
    """
    t = transform_columns()

    def vertex(p: Column) -> Column:
        u, v = to_pixel(p["x"], p["y"], t)
        return F.struct(u.alias("x"), v.alias("y"))

    rings = F.transform(polygon_of(polygons.columns), lambda ring: F.transform(ring, vertex))
    in_pixels = polygons.select("scene_id", "polygon_id", *keep, rings.alias("rings"))
    edges = in_pixels.select("scene_id", "polygon_id", *keep, F.inline(polygon_edges(F.col("rings"))))
    # centre lines row + 0.5 within [lower end, upper end)
    first_row = F.ceil(F.least("y1", "y2") - 0.5).cast("int")
    last_row = F.ceil(F.greatest("y1", "y2") - 0.5).cast("int") - 1
    rows = edges.where(first_row <= last_row).withColumn("row", F.explode(F.sequence(first_row, last_row)))
    edge = {n: F.col(n) for n in ("x1", "y1", "x2", "y2")}
    line = F.col("row") + F.lit(0.5)
    crossings = rows.where(crosses_line(edge, line)).select(
        "scene_id", "polygon_id", "row", *keep, crossing_x(edge, line).alias("enter")
    )
    key = ["scene_id", "polygon_id", "row"]
    along = Window.partitionBy(*key).orderBy("enter")
    paired = crossings.withColumns({"leave": F.lead("enter").over(along), "k": F.row_number().over(along)})
    # centres col + 0.5 within [enter, leave)
    ends = {"first_col": F.ceil(F.col("enter") - 0.5), "last_col": F.ceil(F.col("leave") - 0.5) - 1}
    spans = paired.where("k % 2 = 1").select(*key, *keep, *[c.cast("int").alias(n) for n, c in ends.items()])
    dealt = spans.where("first_col <= last_col").repartition(_tasks(in_pixels), *key)
    return dealt.select(*key, *keep, F.explode(F.sequence("first_col", "last_col")).alias("col"))


def _tasks(in_pixels: DataFrame) -> int:
    """Tasks for the pixels in the boxes of polygons; spans are small, so their bytes do not tell."""
    box = polygon_bounds(F.col("rings"))
    area = (box["xmax"] - box["xmin"] + 1) * (box["ymax"] - box["ymin"] + 1)
    pixels = in_pixels.agg(F.sum(area)).first()[0] or 0
    return int(min(max(pixels // PIXELS_A_TASK, 1), 100_000))


def zonal_stats(pixels: DataFrame, polygons: DataFrame, values: Sequence[str]) -> DataFrame:
    """Count, mean, max, min and population std of the valid pixels of every polygon.

    Null and NaN pixels do not count. Polygons without pixels are kept with count 0. The mask must not be
    broadcast: its size is taken from that of its spans, which unfold to many times as many pixels.
    """
    columns = pixels.select(*PIXEL_KEY, *values)
    return summarize(polygon_mask(polygons).hint("merge").join(columns, PIXEL_KEY), polygons, values)


def summarize(covered: DataFrame, polygons: DataFrame, values: Sequence[str]) -> DataFrame:
    """Statistics per polygon of covered pixels that already have their values."""
    valid = covered.withColumns({v: F.when(~F.isnan(v), F.col(v)) for v in values})
    stats = valid.groupBy("scene_id", "polygon_id").agg(
        *[
            measure
            for v in values
            for measure in (
                F.count(v).alias(f"{v}_count"),
                F.avg(v).alias(f"{v}_mean"),
                F.max(v).alias(f"{v}_max"),
                F.min(v).alias(f"{v}_min"),
                F.stddev_pop(v).alias(f"{v}_std"),
            )
        ]
    )
    kept = polygons.drop("ring", "rings", *TRANSFORM)
    return kept.join(stats, ["scene_id", "polygon_id"], "left").fillna(
        0, [f"{v}_count" for v in values]
    )


def pool_stats(
    stats: DataFrame, by: Sequence[str], values: Sequence[str] = INDICES, order: str | None = None
) -> DataFrame:
    """Combine the statistics of several polygons of one lot.

    With ``order``, ``image_id`` is that of the first tile that met the lot.
    """
    measures = []
    for v in values:
        n, mean = F.col(f"{v}_count"), F.col(f"{v}_mean")
        std = F.coalesce(F.col(f"{v}_std"), F.lit(0.0))
        measures += [
            F.sum(n).alias(f"{v}_count"),
            F.sum(n * mean).alias(f"{v}_sum"),
            F.sum((std * std + mean * mean) * n).alias(f"{v}_sum_sq"),
            F.max(f"{v}_max").alias(f"{v}_max"),
            F.min(f"{v}_min").alias(f"{v}_min"),
        ]
    if order is not None:
        measures.append(F.min_by("image_id", order).alias("image_id"))
    return stats.groupBy(*by).agg(*measures)


def finalize_stats(pooled: DataFrame, values: Sequence[str] = INDICES, digits: int = 4) -> DataFrame:
    """Mean, max, min and std of the pooled sums, rounded; nulls where nothing was counted."""
    sums = [f"{v}_{s}" for v in values for s in ("count", "sum", "sum_sq", "max", "min")]
    kept = [c for c in pooled.columns if c not in sums]
    out = []
    for v in values:
        n = F.col(f"{v}_count")
        mean = F.col(f"{v}_sum") / F.when(n > 0, n)
        variance = F.col(f"{v}_sum_sq") / F.when(n > 0, n) - mean * mean
        std = F.when(n > 0, F.sqrt(F.greatest(F.lit(0.0), variance)))
        by_name = {"mean": mean, "max": F.col(f"{v}_max"), "min": F.col(f"{v}_min"), "std": std}
        out += [F.round(by_name[s], digits).alias(f"{v}_{s}") for s in STATISTICS]
    return pooled.select(*kept, *out)


def pixel_windows(bounds: DataFrame, margin: float = 0.0) -> DataFrame:
    """Boxes with the transform of their scene as windows of whole pixels.

    Adds ``first_row, last_row, first_col, last_col``: pixels whose centre may lie in the box, widened by
    ``margin`` pixels. Boxes that cover no centre are dropped.
    """
    corners = [to_pixel(F.col(x), F.col(y), transform_columns()) for x in ("xmin", "xmax") for y in ("ymin", "ymax")]
    us, vs = zip(*corners)

    def span(values: tuple[Column, ...]) -> tuple[Column, Column]:
        # a little wider, for rounding; the exact test of the centres follows
        low = F.ceil(F.least(*values) - (0.5 + margin + 1e-6)).cast("int")
        return low, F.floor(F.greatest(*values) - (0.5 - margin - 1e-6)).cast("int")

    (first_col, last_col), (first_row, last_row) = span(us), span(vs)
    windows = bounds.withColumns(
        {"first_row": first_row, "last_row": last_row, "first_col": first_col, "last_col": last_col}
    )
    return windows.where("first_row <= last_row and first_col <= last_col")


def block_name(scene: Column, row_block: Column, col_block: Column) -> Column:
    """Name of a block of the pixel store; one name, so that pruning by it is exact."""
    return F.concat(scene, F.lit(":"), row_block.cast("string"), F.lit(":"), col_block.cast("string"))


def block_number(place: Column, block: int) -> Column:
    return F.floor(place / block).cast("int")


def window_blocks(windows: DataFrame, block: int) -> DataFrame:
    """Every window once for each block of the pixel store that it meets."""

    def blocks(first: str, last: str) -> Column:
        return F.explode(F.sequence(block_number(F.col(first), block), block_number(F.col(last), block)))

    spread = windows.withColumn("row_block", blocks("first_row", "last_row")).withColumn(
        "col_block", blocks("first_col", "last_col")
    )
    name = block_name(F.col("scene_id"), F.col("row_block"), F.col("col_block"))
    return spread.withColumn(BLOCK_KEY, name).drop("scene_id", "row_block", "col_block")


def clip_pixels(
    pixels: DataFrame, bounds: DataFrame, margin: float = 0.0, block: int | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Window read: the pixels whose centre lies in the bounds of their scene.

    ``bounds`` has rows of ``scene_id``, a box, the transform columns and the columns ``keep``, which the
    pixels get; a pixel comes once for each box of its scene that holds it. ``margin`` widens the
    boxes by so many pixels. The windows are stored, so that Spark knows their size: small ones are broadcast
    and pixels outside never reach a shuffle. Of a pixel store of this ``block`` (``sources.pixel_store``) only
    the blocks that windows meet are read, by pruning its partitions at run time.
    """
    t = transform_columns()
    windows = pixel_windows(bounds, margin)
    if block is not None:
        windows = window_blocks(windows, block)
    x, y = pixel_center(F.col("col"), F.col("row"), t)
    dx = (F.abs(t["a"]) + F.abs(t["b"])) * margin
    dy = (F.abs(t["d"]) + F.abs(t["e"])) * margin
    inside = x.between(F.col("xmin") - dx, F.col("xmax") + dx) & y.between(F.col("ymin") - dy, F.col("ymax") + dy)
    window = F.col("row").between(F.col("first_row"), F.col("last_row")) & F.col("col").between(
        F.col("first_col"), F.col("last_col")
    )
    # as a filter of the stored windows it also tells Spark that they are worth pruning by
    chosen = stored(windows).where("first_row <= last_row")
    clipped = pixels.join(chosen, BLOCK_KEY if block is not None else "scene_id").where(window & inside)
    return clipped.select(*[c for c in pixels.columns if block is None or c != BLOCK_KEY], *keep)


def resample_bilinear(targets: DataFrame, coarse: DataFrame, value: str = "value") -> DataFrame:
    """Value of a coarse band at the centre of every target pixel, by bilinear weights.

    ``targets`` has the pixel key and the transforms ``fine_a..f`` and
    ``coarse_a..f``, which are dropped; other columns stay. ``coarse`` has the
    pixel key and the value. Neighbours outside the band or without a value are
    left out and the weights rescaled; null if none is left.

    The coarse band is first regrouped into cells of 2 x 2 neighbours, so every
    target pixel travels once, to its cell, and not once per neighbour.
    """
    names = [f"v{j}{i}" for j in (0, 1) for i in (0, 1)]
    member = F.array(
        *[
            F.struct(
                (F.col("row") - j).alias("cell_row"),
                (F.col("col") - i).alias("cell_col"),
                F.lit(f"v{j}{i}").alias("place"),
            )
            for j in (0, 1)
            for i in (0, 1)
        ]
    )
    cells = (
        coarse.where(F.col(value).isNotNull() & ~F.isnan(value))
        .select("scene_id", F.col(value), F.inline(member))
        .groupBy("scene_id", "cell_row", "cell_col")
        .agg(*[F.max(F.when(F.col("place") == n, F.col(value))).alias(n) for n in names])
    )
    x, y = pixel_center(F.col("col"), F.col("row"), transform_columns("fine_"))
    u, v = to_pixel(x, y, transform_columns("coarse_"))
    transforms = [f"{p}{n}" for p in ("fine_", "coarse_") for n in TRANSFORM]
    kept = [c for c in targets.columns if c not in transforms]
    at = targets.withColumns({"u": u - 0.5, "v": v - 0.5}).select(
        *kept,
        F.floor("v").cast("int").alias("cell_row"),
        F.floor("u").cast("int").alias("cell_col"),
        (F.col("u") - F.floor("u")).alias("du"),
        (F.col("v") - F.floor("v")).alias("dv"),
    )
    du, dv = F.col("du"), F.col("dv")
    weights = {
        f"v{j}{i}": (du if i else 1 - du) * (dv if j else 1 - dv) for j in (0, 1) for i in (0, 1)
    }
    zero = F.lit(0.0)
    total = sum((F.when(F.col(n).isNotNull(), w).otherwise(zero) for n, w in weights.items()), zero)
    part = sum((F.coalesce(F.col(n) * w, zero) for n, w in weights.items()), zero)
    found = at.join(cells, ["scene_id", "cell_row", "cell_col"], "left")
    return found.select(*kept, (part / F.nullif(total, zero)).alias(value))


def coverage(indices: DataFrame) -> DataFrame:
    """How many lots have an NDVI value, out of how many."""
    return indices.agg(F.count("ndvi_mean").alias("lots_with_ndvi"), F.count("*").alias("lots"))


def effective_transforms(transforms: DataFrame) -> DataFrame:
    """Transform to use per scene: that of the world file if it has one, else its own.

    A scene whose world file is broken, or whose transform can't be used, has none and is left out.
    """
    own = F.struct(*TRANSFORM)
    if "world_file" not in transforms.columns:
        return transforms.select("scene_id", *TRANSFORM).where(usable_transform(transform_columns()))
    used = F.coalesce(world_file(F.col("world_file")), own).alias("used")
    sound = transforms.where(~world_file_broken(F.col("world_file"))).select("scene_id", used)
    return sound.select("scene_id", "used.*").where(usable_transform(transform_columns()))
