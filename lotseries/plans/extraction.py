"""Extraction jobs: from polygons and pixels to index statistics per lot and date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotseries.functions.geometry import TRANSFORM, usable_transform
from lotseries.functions.indices import spectral_indices
from lotseries.operators import catalog, manifest, raster
from lotseries.operators.raster import PIXEL_KEY
from lotseries.schema import INDEX_COLUMNS, INDICES
from lotseries.sources.stored import stored

FINE_BANDS = ["nir", "red"]
COARSE_BAND = "swir16"


def _grids(transforms: DataFrame, band: str, prefix: str = "") -> DataFrame:
    return transforms.where(F.col("band") == band).select(
        "scene_id", *[F.col(n).alias(f"{prefix}{n}") for n in TRANSFORM]
    )


def choose_scenes(lots: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Scenes to use per day: found, least cloudy of their tile, with all assets."""
    found = catalog.search_scenes(catalogue, lots)
    return catalog.with_required_assets(catalog.best_scene_per_tile(found))


def _windows(polygons: DataFrame, grids: DataFrame | None = None) -> DataFrame:
    """Bounds of the polygons measured in each scene, with a transform: that of the polygons' rows, or of ``grids``."""
    if grids is None:
        return catalog.total_bounds(polygons, ["scene_id", *TRANSFORM])
    return catalog.total_bounds(polygons, ["scene_id"]).join(grids, "scene_id")


def band_values(
    polygons: DataFrame, pixels: DataFrame, transforms: DataFrame, block: int | None = None
) -> DataFrame:
    """Index values of the pixels covered by polygons: fine bands looked up, the coarse resampled.

    The fine bands share a grid; one scan clips both and one shuffle brings them together.
    """
    rows = [*PIXEL_KEY, "band", "value"] + ([raster.BLOCK_KEY] if block is not None else [])
    chosen = pixels.where(F.col("band").isin(*FINE_BANDS)).select(*rows)
    fine = raster.clip_pixels(chosen, _windows(polygons), 0.5, block)
    by_band = [F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in FINE_BANDS]
    wide = fine.groupBy(*PIXEL_KEY).agg(*by_band)
    # a coarse neighbour may lie up to one coarse pixel outside the window
    bounds = _windows(polygons, _grids(transforms, COARSE_BAND))
    coarse = raster.clip_pixels(pixels.where(F.col("band") == COARSE_BAND).select(*rows), bounds, 1.5, block)
    coarse = coarse.select(*PIXEL_KEY, F.col("value").alias(COARSE_BAND))

    # both transforms travel with the polygons, not by a join of pixels on their scene
    names = [f"{p}{n}" for p in ("fine_", "coarse_") for n in TRANSFORM]
    placed = polygons.withColumns({f"fine_{n}": F.col(n) for n in TRANSFORM}).join(
        _grids(transforms, COARSE_BAND, "coarse_"), "scene_id"
    )
    covered = raster.polygon_mask(placed, names)
    bands = raster.resample_bilinear(covered, coarse, COARSE_BAND).join(wide, PIXEL_KEY, "left")
    values = spectral_indices(F.col("nir"), F.col("red"), F.col(COARSE_BAND))
    return bands.select("polygon_id", *PIXEL_KEY, *[c.alias(n) for n, c in values.items()])


def readable_scenes(pixels: DataFrame, transforms: DataFrame) -> DataFrame:
    """Scenes (``scene_id``) of which every band has pixels and a usable transform. Only names are looked at."""
    yes, no = F.lit(True), F.lit(False)
    grids = transforms.where(usable_transform({n: F.col(n) for n in TRANSFORM}))
    marks = pixels.select("scene_id", "band", yes.alias("has_pixels"), no.alias("has_grid")).union(
        grids.select("scene_id", "band", no.alias("has_pixels"), yes.alias("has_grid"))
    )
    bands = marks.where(F.col("band").isin(*FINE_BANDS, COARSE_BAND)).groupBy("scene_id", "band").agg(
        (F.max("has_pixels") & F.max("has_grid")).alias("readable")
    )
    whole = bands.where("readable").groupBy("scene_id").agg(F.count("*").alias("bands"))
    return whole.where(F.col("bands") == len(FINE_BANDS) + 1).select("scene_id")


def extract_scene_indices(
    lots: DataFrame,
    catalogue: DataFrame,
    pixels: DataFrame,
    transforms: DataFrame,
    block: int | None = None,
) -> DataFrame:
    """Indices per lot and day from scene bands.

    ``lots``: ``obs_date, polygon_id, lot_id`` and ``ring`` or ``rings``, one set per day. Pixels and
    transforms hold the bands nir, red and swir16 of every scene; a scene that lacks one is passed over, as if it
    were not there, and its polygons go to the next tile. The choice of
    scene per polygon is stored, since windows, masks and results all start from it. ``block``: the
    pixels are a pixel store with blocks of this size.
    """
    chosen = choose_scenes(lots, catalogue).select("obs_date", "tile_order", "scene_id", *catalog.BOX)
    scenes = stored(chosen.join(readable_scenes(pixels, transforms), "scene_id", "left_semi"))
    pairs = catalog.lots_touching_tiles(lots, scenes, ["obs_date"])
    assigned = stored(
        catalog.assign_first_tile(pairs, lots, scenes.drop(*catalog.BOX), ["obs_date"])
        .join(_grids(transforms, "nir"), "scene_id")
    )
    values = band_values(assigned, pixels, transforms, block)
    stats = raster.summarize(values, assigned, INDICES).withColumn("image_id", F.col("scene_id"))
    pooled = raster.pool_stats(stats, ["lot_id", "obs_date"], order="tile_order")
    return _output(raster.finalize_stats(pooled))


def sound_dates(rasters: DataFrame, pixels: DataFrame, grids: DataFrame) -> DataFrame:
    """Dates (``obs_date``) none of whose rasters fails.

    ``rasters`` has a row per date and index. Each needs pixels and a usable transform (a row of ``grids``). Only names are
    looked at, before any pixel moves: the pixel table gives its distinct scenes, combined before their shuffle.
    A lot file without lots needs no look, as nothing joins with it.
    """
    yes, no = F.lit(True), F.lit(False)
    marks = pixels.select("scene_id", yes.alias("has_pixels"), no.alias("has_grid")).union(
        grids.select("scene_id", no.alias("has_pixels"), yes.alias("has_grid"))
    )
    seen = marks.groupBy("scene_id").agg((F.max("has_pixels") & F.max("has_grid")).alias("readable"))
    checked = rasters.join(seen, "scene_id", "left")
    sound = checked.groupBy("obs_date").agg(F.min(F.coalesce("readable", no)).alias("sound"))
    return sound.where("sound").select("obs_date")


def extract_raster_indices(
    files: DataFrame, lots: DataFrame, pixels: DataFrame, transforms: DataFrame, block: int | None = None
) -> DataFrame:
    """Indices per lot and day from ready index rasters.

    ``files`` is a manifest; only dates with all three rasters and a lot file are used, and of those
    only dates none of whose inputs fails (``sound_dates``). ``lots`` has the column ``stem`` of its lot file, pixels
    and transforms have the raster's path as ``scene_id``. A raster may have a world file text (``world_file``), which
    then replaces its own transform. ``block``: the pixels are a pixel store with blocks of this size.
    """
    dates = manifest.complete_dates(manifest.latest_asset(manifest.classify_assets(files)))
    name = F.element_at(F.split("lots", "/"), -1)
    sets = dates.withColumns(
        {
            "obs_date": F.to_date("date", "yyyyMMdd"),
            "stem": F.regexp_replace(name, r"\.shp$", ""),
            "image_id": F.element_at(F.split("ndvi", "/"), -2),
        }
    )
    kinds = [F.struct(F.lit(i).alias("index"), F.col(i).alias("scene_id")) for i in INDICES]
    rasters = stored(sets.select("obs_date", "stem", "image_id", F.inline(F.array(*kinds))))
    grids = raster.effective_transforms(transforms)
    sound = rasters.join(sound_dates(rasters, pixels, grids), "obs_date", "left_semi")
    polygons = stored(lots.join(sound, "stem").join(grids, "scene_id"))
    window = raster.clip_pixels(pixels, _windows(polygons), 0.5, block)
    stats = raster.zonal_stats(window, polygons, ["value"])
    # one column group per index, so that the three rasters of a date meet in one aggregate
    by_index = stats.withColumns(
        {
            f"{i}_{s}": F.when(F.col("index") == i, F.col(f"value_{s}"))
            for i in INDICES
            for s in ("count", "mean", "max", "min", "std")
        }
    )
    pooled = raster.pool_stats(by_index, ["lot_id", "obs_date", "image_id"])
    return _output(raster.finalize_stats(pooled))


def _output(indices: DataFrame) -> DataFrame:
    """The fixed columns of the extraction output; the date as ISO text."""
    return indices.withColumn("obs_date", F.date_format("obs_date", "yyyy-MM-dd")).select(
        *INDEX_COLUMNS
    )
