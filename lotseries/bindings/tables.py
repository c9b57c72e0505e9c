"""Inputs of the operators, derived from whole benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotseries.functions.geometry import TRANSFORM
from lotseries.functions.season import season_label
from lotseries.operators.cycles import lot_days
from lotseries.plans.training import master_table

# Layout of the mosaic made of the 8 x 8 patches of `embeddings`.
PATCH = 8
PATCHES_ACROSS = 25
TILE_PATCHES = 5
# Tiles whose scenes fail.
NO_SWIR = 102
FLAT_TRANSFORM = 201
# Labels whose ready rasters fail.
NO_PIXELS = 3
BAD_WORLD_FILE = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer of their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _bands() -> dict[str, Column]:
    quantity = F.max("l_quantity")
    return {
        "nir": F.max("l_extendedprice"),
        "red": quantity * 500,
        "swir": quantity * (F.max("l_discount") * 5000 + 200),
        "noise": F.max("l_tax"),
        "part": F.max("l_suppkey"),
    }


def lot_bands(items: DataFrame, by_lot: bool = False) -> DataFrame:
    """Band values per lot (customer) and day (ship date).

    ``by_lot``: the line items are sent to their lot, where the bands then lie; nearly every one is a day of its own, so
    that combining them before would save next to nothing. A task holds one row per lot and day.
    """
    lot, day = F.col("o_custkey").cast("string"), F.to_date("l_shipdate")
    if by_lot:
        used = ["l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_suppkey"]
        partitions = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        items = items.select(lot.alias("lot_id"), *used).repartition(partitions, "lot_id")
        lot = F.col("lot_id")
    return items.groupBy(lot.alias("lot_id"), day.alias("obs_date")).agg(
        *[c.alias(n) for n, c in _bands().items()]
    )


def _difference(a: str, b: str) -> Column:
    return (F.col(a) - F.col(b)) / (F.col(a) + F.col(b))


def observations(spark: SparkSession, sf_dir: str, by_lot: bool = False) -> DataFrame:
    ndvi = F.round(_difference("nir", "red"), 4)
    day = F.date_format("obs_date", "yyyyMMdd")
    return lot_bands(shipments(spark, sf_dir), by_lot).select(
        "lot_id",
        "obs_date",
        F.concat(F.lit("S2A_"), F.col("part").cast("string"), F.lit("_"), day).alias("image_id"),
        F.when(F.col("noise") < 0.08, ndvi * 0.83 + F.col("noise")).alias("ndvi_corrected"),
        ndvi.alias("ndvi_ref"),
    )


def yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows per lot, season and order status: some seasons have two harvests."""
    season = F.concat(F.lit("Zafra "), F.replace(season_label(F.to_date("o_orderdate")), F.lit("_"), F.lit("-")))
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus").isin("F", "P"))
        .groupBy(
            F.col("o_custkey").cast("string").alias("lot"),
            season.alias("season"),
            F.col("o_orderstatus").alias("status"),
        )
        .agg(
            F.date_format(F.min("o_orderdate"), "dd/MM/yyyy").alias("harvest"),
            F.max("o_totalprice").alias("tch"),
        )
    )


def master(spark: SparkSession, sf_dir: str, by_lot: bool = False) -> DataFrame:
    return master_table(observations(spark, sf_dir, by_lot), yields(spark, sf_dir), by_lot)


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lot_days(master(spark, sf_dir))


def reference_source(spark: SparkSession, sf_dir: str, bands: DataFrame | None = None) -> DataFrame:
    """Index means of all line items; ``bands`` may hold their ``lot_bands``."""
    bands = lot_bands(shipments(spark, sf_dir)) if bands is None else bands
    return bands.select(
        "lot_id",
        "obs_date",
        F.year("obs_date").alias("year"),
        _difference("nir", "red").alias("ndvi_mean"),
        _difference("nir", "swir").alias("ndwi11_mean"),
        (F.col("swir") / F.col("nir")).alias("msi11_mean"),
    )


def scene_source(spark: SparkSession, sf_dir: str, bands: DataFrame | None = None) -> DataFrame:
    """Index means of all line items, distorted; some are out of range. ``bands`` as in ``reference_source``."""
    bands = lot_bands(shipments(spark, sf_dir)) if bands is None else bands
    noise = F.col("noise")
    return bands.select(
        "lot_id",
        "obs_date",
        F.concat(F.lit("S2A_"), F.col("part").cast("string")).alias("image_id"),
        (_difference("nir", "red") * 1.1 + noise).alias("ndvi_mean"),
        (_difference("nir", "swir") * 1.05 - noise).alias("ndwi11_mean"),
        (F.col("swir") / F.col("nir") * 1.2 + noise).alias("msi11_mean"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File paths from `events`: the type gives the kind, user and time give the date."""
    day = F.date_add(F.to_date("ts"), (F.col("user_id") * 30).cast("int"))
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", "01-NDVI_")
        .when(kind == "click", "02-NDWI-11_")
        .when(kind == "error", "04-MSI-11_")
        .when(kind == "purchase", "lots_")
        .otherwise("readme_")
    )
    suffix = F.when(kind == "purchase", ".shp").when(kind == "signup", ".TIF").otherwise(".tif")
    return table(spark, sf_dir, "events").select(
        F.concat(
            F.lit("Reference/"),
            F.year(day).cast("string"),
            F.lit("-raster/batch"),
            (F.col("event_id") % 7).cast("string"),
            F.lit("/"),
            name,
            F.date_format(day, "yyyyMMdd"),
            suffix,
        ).alias("path")
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes from `orders`: 50 tiles in a 10 x 5 layout, some cloudy, some without swir16."""
    tile = F.col("o_custkey") % 50
    x, y = (tile % 10) * 20.0, F.floor(tile / 10) * 32.0
    assets = F.array(
        F.lit("nir"), F.lit("red"), F.when(F.col("o_orderstatus") != "P", F.lit("swir16"))
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("S2A_"), tile.cast("string"), F.lit("_"), F.col("o_orderkey").cast("string")
        ).alias("scene_id"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderdate").alias("datetime"),
        F.when(
            F.col("o_orderpriority") != "5-LOW", F.floor("o_totalprice") % 101
        ).cast("double").alias("cloud_cover"),
        F.map_from_entries(
            F.transform(F.filter(assets, lambda a: a.isNotNull()), lambda a: F.struct(a, a))
        ).alias("assets"),
        x.alias("xmin"),
        y.cast("double").alias("ymin"),
        (x + 21.0).alias("xmax"),
        (y + 33.0).cast("double").alias("ymax"),
    )


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon per supplier: a concave part with a hole, and a triangle. The suppliers of a nation form one lot."""
    x = F.col("s_suppkey") * 37 % 200 + 0.13
    y = (F.col("s_acctbal") + 1000) / 11000 * 160 + 0.0137
    w = F.col("s_nationkey") / 4 + 3
    outlines = [
        [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (0.0, 0.3), (-1.0, 1.0)],
        [(-0.25, -0.7), (0.25, -0.7), (0.25, -0.2), (-0.25, -0.2)],
        [(1.4, -0.5), (2.2, -0.2), (1.5, 0.6)],
    ]
    rings = F.array(
        *[
            F.array(*[F.struct((x + w * i).alias("x"), (y + w * j).alias("y")) for i, j in corners])
            for corners in outlines
        ]
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("polygon_id"),
        F.concat(F.lit("lot"), F.col("s_nationkey").cast("string")).alias("lot_id"),
        rings.alias("rings"),
    )


def dated_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons per ship date of their supplier."""
    dates = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("polygon_id"), F.to_date("l_shipdate").alias("obs_date")
    )
    # the days of a polygon side by side, so that its rings are stored and told apart once
    return lots(spark, sf_dir).join(dates.repartition("polygon_id").distinct(), "polygon_id")


def grid(c: Column, f: Column, size: float = 1.0) -> list[Column]:
    """Transform columns of an unrotated grid."""
    values = [F.lit(size), F.lit(0.0), c, F.lit(0.0), F.lit(size), f]
    return [v.alias(n) for v, n in zip(values, TRANSFORM)]


def patch_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of the patches: ``vec_id, label``, place in the mosaic, value and mirrored value."""
    vectors = table(spark, sf_dir, "embeddings").withColumn("mirror", F.reverse("embedding"))
    patches = vectors.select(
        "vec_id", "label", F.posexplode(F.arrays_zip("embedding", "mirror"))
    )
    patch_row = F.floor(F.col("vec_id") / PATCHES_ACROSS).cast("int")
    patch_col = (F.col("vec_id") % PATCHES_ACROSS).cast("int")
    i = F.col("pos")
    return patches.select(
        "vec_id",
        "label",
        (patch_row * PATCH + F.floor(i / PATCH)).cast("int").alias("row"),
        (patch_col * PATCH + i % PATCH).cast("int").alias("col"),
        F.col("col.embedding").cast("double").alias("value"),
        F.col("col.mirror").cast("double").alias("mirror"),
    )


def _mosaic_id(key: str) -> Column:
    """Scene id of the only scene, as a value of the row: a constant would drop out of the join keys."""
    return F.when(F.col(key) >= 0, "mosaic").alias("scene_id")


def mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All patches as one scene; negative values of the upper range count as no data."""
    pixels = patch_pixels(spark, sf_dir)
    value = F.when(F.col("value") < -0.3, F.lit(float("nan"))).otherwise(F.col("value"))
    return pixels.select(_mosaic_id("vec_id"), "row", "col", value.alias("value"))


def mosaic_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lots(spark, sf_dir).select(
        _mosaic_id("polygon_id"), "*", *grid(F.lit(0.25), F.lit(-0.5))
    )


def _tile(row: str, col: str) -> Column:
    side = PATCH * TILE_PATCHES
    number = F.floor(F.col(row) / side) * 100 + F.floor(F.col(col) / side)
    return number.cast("int")


def scene_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mosaic cut into tiles of 40 x 40 pixels; swir16 has half the resolution and is missing in one tile."""
    side = PATCH * TILE_PATCHES
    tiled = patch_pixels(spark, sf_dir).select(
        F.concat(F.lit("S2A_"), _tile("row", "col").cast("string"), F.lit("_0")).alias("scene_id"),
        (F.col("row") % side).alias("row"),
        (F.col("col") % side).alias("col"),
        "value",
        "mirror",
    )

    def band(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.select("scene_id", F.lit(name).alias("band"), "row", "col", value.alias("value"))

    known = F.col("scene_id") != f"S2A_{NO_SWIR}_0"
    coarse = tiled.where(known & (F.col("row") % 2 == 0) & (F.col("col") % 2 == 0)).withColumns(
        {"row": (F.col("row") / 2).cast("int"), "col": (F.col("col") / 2).cast("int")}
    )
    return (
        band(tiled, "nir", F.col("value") + 0.4)
        .unionByName(band(tiled, "red", F.col("mirror") + 0.2))
        .unionByName(band(coarse, "swir16", F.col("value") * 0.5 + 0.3))
    )


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = PATCH * TILE_PATCHES
    patches = table(spark, sf_dir, "embeddings").select(
        (F.floor(F.col("vec_id") / PATCHES_ACROSS) * PATCH).alias("row"),
        (F.col("vec_id") % PATCHES_ACROSS * PATCH).alias("col"),
    )
    tiles = patches.groupBy(_tile("row", "col").alias("tile")).agg(F.count("*").alias("patches"))
    return tiles.withColumns(
        {
            "x": (F.col("tile") % 100 * side + 0.25).cast("double"),
            "y": (F.floor(F.col("tile") / 100) * side - 0.5).cast("double"),
        }
    )


def scene_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scene per tile of the mosaic, on one day."""
    side = float(PATCH * TILE_PATCHES)
    return _tiles(spark, sf_dir).select(
        F.concat(F.lit("S2A_"), F.col("tile").cast("string"), F.lit("_0")).alias("scene_id"),
        F.col("tile").alias("pos"),
        F.to_timestamp(F.lit("2024-01-01 16:30:00")).alias("datetime"),
        F.col("patches").cast("double").alias("cloud_cover"),
        F.create_map(*[F.lit(a) for n in ("nir", "red", "swir16") for a in (n, n)]).alias("assets"),
        F.col("x").alias("xmin"),
        F.col("y").alias("ymin"),
        (F.col("x") + side).alias("xmax"),
        (F.col("y") + side).alias("ymax"),
    )


def scene_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = _tiles(spark, sf_dir)
    scene = F.concat(F.lit("S2A_"), F.col("tile").cast("string"), F.lit("_0")).alias("scene_id")

    def of(band: str, size: float) -> DataFrame:
        placed = tiles.select("tile", scene, F.lit(band).alias("band"), *grid(F.col("x"), F.col("y"), size))
        flat = (F.col("tile") == FLAT_TRANSFORM) & (F.col("band") == "red")
        return placed.withColumn("e", F.when(flat, 0.0).otherwise(F.col("e"))).drop("tile")

    return of("nir", 1.0).unionByName(of("red", 1.0)).unionByName(of("swir16", 2.0))


def raster_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ready rasters, one date per label; the highest label has no lot file.

    Two more dates fail: the water index of label 3 has no pixels, the world file of the last index of
    label 5 holds a line that is no number.
    """
    labels = table(spark, sf_dir, "embeddings").select("label").distinct()
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("label")), "yyyyMMdd")
    fragments = {"01-NDVI_": ".tif", "02-NDWI-11_": ".tif", "04-MSI-11_": ".tif", "lots_": ".shp"}
    paths = [
        F.concat(F.lit("Reference/2024-raster/sugar/"), F.lit(n), day, F.lit(s))
        for n, s in fragments.items()
    ]
    return (
        labels.select("label", F.explode(F.array(*paths)).alias("path"))
        .where((F.col("label") < 9) | ~F.col("path").endswith(".shp"))
        .select("path")
    )


def raster_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of the rasters of ``raster_files``: the patches of the label, three values each."""
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("label")), "yyyyMMdd")
    values = {
        "01-NDVI_": F.col("value"),
        "02-NDWI-11_": F.col("mirror"),
        "04-MSI-11_": F.col("value") * 2 + 1,
    }
    rows = [
        F.struct(
            F.concat(F.lit(f"Reference/2024-raster/sugar/{n}"), day, F.lit(".tif")).alias("scene_id"),
            v.alias("value"),
        )
        for n, v in values.items()
    ]
    pixels = patch_pixels(spark, sf_dir).select("label", "row", "col", F.inline(F.array(*rows)))
    unread = (F.col("label") == NO_PIXELS) & F.col("scene_id").contains("02-NDWI-11_")
    return pixels.where(~unread).select("scene_id", "row", "col", "value")


def raster_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broken own transform, put right by a world file; one world file is broken itself."""
    bad = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.lit(BAD_WORLD_FILE)), "yyyyMMdd")
    broken = F.col("path").contains(F.concat(F.lit("04-MSI-11_"), bad))
    world = F.when(broken, "1.0\n0.0\nnone\n1.0\n0.25\n-0.5\n").otherwise("1.0\n0.0\n0.0\n1.0\n0.25\n-0.5\n")
    return (
        raster_files(spark, sf_dir)
        .where(F.col("path").endswith(".tif"))
        .select(
            F.col("path").alias("scene_id"),
            *grid(F.lit(0.0), F.lit(0.0), 5.0),
            world.alias("world_file"),
        )
    )


def raster_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    stems = raster_files(spark, sf_dir).where(F.col("path").endswith(".shp")).select(
        F.regexp_extract("path", r"([^/]+)\.shp$", 1).alias("stem")
    )
    # each lot file holds the polygons of one label's suppliers
    label = F.regexp_extract("stem", r"(\d)$", 1).cast("int") - 1
    return lots(spark, sf_dir).withColumn("label", (F.col("polygon_id") % 10).cast("int")).join(
        stems.withColumn("label", label), "label"
    ).drop("label")


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` written as an HTML report: title, header, one row per order.

    One column has no name, two have the same; some rows have a cell too many, and tags differ in case.
    """

    def row(*cells: Column) -> Column:
        return F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))], F.lit("</tr>"))

    def text(*cells: str) -> Column:
        return row(*[F.lit(c) for c in cells])

    title, names = ("Reporte", "", ""), ("Pedido N°", "Lote", "Cierre ", "Producción", "", "Área (ha)", "Lote")
    head = spark.range(1).select(
        F.inline(
            F.array(
                F.struct(F.lit(-2).cast("long").alias("file"), text(*title).alias("html")),
                F.struct(F.lit(-1).cast("long").alias("file"), text(*names).alias("html")),
            )
        )
    )
    cells = [
        F.col("o_orderkey").cast("string"),
        F.concat(F.lit("<b>"), F.col("o_custkey").cast("string"), F.lit("</b> ")),
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.format_string("%.2f", "o_totalprice"),
        F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")),
        F.when(F.col("o_orderpriority") == "5-LOW", "7d").otherwise(F.substring("o_orderpriority", 1, 1)),
        F.concat(F.lit("L"), (F.col("o_custkey") % 100).cast("string")),
    ]
    key = F.col("o_orderkey")
    longer = F.when(key % 5 == 0, row(*cells, F.lit("one too many"))).otherwise(row(*cells))
    shouted = F.when(key % 3 == 0, F.replace(F.replace(longer, F.lit("tr>"), F.lit("TR>")), F.lit("<td>"), F.lit("<TD>")))
    body = table(spark, sf_dir, "orders").select(key.alias("file"), F.coalesce(shouted, longer).alias("html"))
    return head.unionByName(body)


def report_file(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The report as text files below ``path``, in the order of their names."""
    report_rows(spark, sf_dir).orderBy("file").select("html").write.text(path)
