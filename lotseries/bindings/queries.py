"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotseries.bindings import tables as t
from lotseries.functions.geometry import pixel_center, polygon_bounds
from lotseries.functions.indices import spectral_indices
from lotseries.functions.text import slug_column
from lotseries.operators import (
    calibrate,
    catalog,
    cycles,
    explore,
    feeds,
    manifest,
    master,
    raster,
    report_html,
    reports,
    sampling,
)
from lotseries.operators.matching import clean_ranges
from lotseries.plans import extraction, training
from lotseries.plans.calibration import calibrate_sources, matched_sources
from lotseries.sources import pixel_store, readers, writers
from lotseries.sources.merge import reset_columns
from lotseries.sources.stored import fresh_path, in_buckets, stored

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
TEST_YEAR = 2000
# Pixel rows and columns of a block of the mosaic's store.
WINDOW_BLOCK = 64


def _rounded(df: DataFrame, digits: int = DIGITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round doubles, so that the order of summation does not show."""
    doubles = [n for n, kind in df.dtypes if kind == "double" and n not in keep]
    return df.withColumns({n: F.round(n, digits) for n in doubles})


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


# --- keys, master, cycles -------------------------------------------------------------


def season_keys(spark: SparkSession, sf: str) -> DataFrame:
    seasons = master.add_season(t.observations(spark, sf))
    return seasons.select("lot_id", "obs_date", "season", "lot_season")


def yield_keys(spark: SparkSession, sf: str) -> DataFrame:
    return master.add_yield_key(t.yields(spark, sf)).select("lot", "season", "status", "lot_season")


def master_left_join(spark: SparkSession, sf: str) -> DataFrame:
    return t.master(spark, sf).select(
        "lot_id", "obs_date", "image_id", "ndvi_ref", "season", "lot_season", "report_season", "harvest", "tch"
    )


_AGE = ["lot_id", "obs_date", "season", "harvest", "crop_age_days"]


def age_since_known_harvest(spark: SparkSession, sf: str) -> DataFrame:
    return master.age_since_known_harvest(t.master(spark, sf)).select(_AGE)


def age_since_previous_season(spark: SparkSession, sf: str) -> DataFrame:
    return master.age_since_previous_season(t.master(spark, sf)).select(_AGE)


def age_with_ratoon(spark: SparkSession, sf: str) -> DataFrame:
    return master.age_with_ratoon(t.master(spark, sf)).select(_AGE)


def season_gap_flags(spark: SparkSession, sf: str) -> DataFrame:
    return master.ratoon_age_and_gaps(t.master(spark, sf)).select(*_AGE, "data_gap")


def season_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return master.season_gaps(t.master(spark, sf))


def rollback_age(spark: SparkSession, sf: str) -> DataFrame:
    """Ages and gaps, then the first rule again: both look up the same table of seasons."""
    rows = t.master(spark, sf)
    seasons = stored(master.lot_seasons(rows))
    rolled = master.rollback_to_first_age(master.ratoon_age_and_gaps(rows, seasons), seasons)
    return rolled.agg(F.count("*").alias("rows"), F.count("crop_age_days").alias("rows_with_age"))


def _stored_master(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The master as a stored table, for the cycles, which read it twice: the columns they need and those named.

    It lies in buckets by lot: with one observation a day, and a yield per order status for its season, no lot is large.
    """
    needed = dict.fromkeys(["lot_id", "obs_date", "harvest", "ndvi_ref", *columns])
    return stored(in_buckets(t.master(spark, sf, by_lot=True).select(*needed), "lot_id"))


def _joined(spark: SparkSession, sf: str, rules: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    rows = _stored_master(spark, sf)
    joined = cycles.attach_by_lot(rows, rules(cycles.lot_days(rows)), columns)
    return joined.select("lot_id", "obs_date", "harvest", *columns)


def next_harvest(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf, cycles.with_cycle_end, ["cycle_end"])


def cycle_age(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf, cycles.harvest_cycles, ["cycle_end", "crop_age_days", "data_gap"])


def renovation_events(spark: SparkSession, sf: str) -> DataFrame:
    days = cycles.harvest_cycles(t.days(spark, sf))
    return cycles.renovation_points(cycles.with_renovation_events(days))


def _cycles(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The master with cycles; ``columns`` are those used besides ``lot_id, obs_date, harvest, ndvi_ref``."""
    return cycles.add_cycles(_stored_master(spark, sf, *columns), by_lot=True)


def _stored_cycles(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The same as a stored table, for queries that read it more than once."""
    return stored(in_buckets(_cycles(spark, sf, *columns), "lot_id"))


def valid_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return _cycles(spark, sf).select("lot_id", "obs_date", "harvest", *cycles.CYCLE_COLUMNS)


def repaired_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Spoil age, gap and validity, then repair them from the cycle ends."""
    spoiled = _stored_cycles(spark, sf).withColumns(
        {"crop_age_days": F.lit(None).cast("int"), "data_gap": F.lit(True), "valid_cycle": F.lit(False)}
    )
    repaired = cycles.recompute_cycles(spoiled, by_lot=True)
    return repaired.select("lot_id", "obs_date", "harvest", *cycles.CYCLE_COLUMNS)


def repaired_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same on a stored table: spoil some seasons in place, repair them, read the table back."""
    path = fresh_path(spark)
    names = ["lot_id", "obs_date", "harvest", *cycles.CYCLE_COLUMNS]
    rows = _cycles(spark, sf, "season").select(*names, "season")
    rows.hint("rebalance", "season").write.partitionBy("season").parquet(path)
    spoiled = {"crop_age_days": F.lit(None), "data_gap": F.lit(True), "valid_cycle": F.lit(False)}
    reset_columns(spark, path, spoiled, ["season"], F.col("season").isin("1996_1997", "1999_2000"))
    training.repair_table(spark, path, ["season"])
    return spark.read.parquet(path).select(*names)


# --- reports --------------------------------------------------------------------------


def ml_dataset(spark: SparkSession, sf: str) -> DataFrame:
    rows = _cycles(spark, sf, "image_id", "season", "tch", "ndvi_corrected")
    return reports.ml_dataset(rows).select(
        "lot_id",
        "obs_date",
        "image_id",
        "season",
        "harvest",
        "tch",
        "ndvi_ref",
        "ndvi_corrected",
        *cycles.CYCLE_COLUMNS,
    )


def dataset_size(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dataset_size(reports.ml_dataset(_cycles(spark, sf, "lot_season")))


def cycle_length_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(reports.cycle_length_buckets(_cycles(spark, sf)))


def renovation_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.renovation_report(_cycles(spark, sf))


def _lot_list(spark: SparkSession, sf: str) -> DataFrame:
    """Lots asked for: the customers of one market segment."""
    customers = t.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return customers.select(F.col("c_custkey").cast("string").alias("lot_id"))


def lot_history(spark: SparkSession, sf: str) -> DataFrame:
    return reports.lot_history(_cycles(spark, sf), _lot_list(spark, sf))


def renovation_markers(spark: SparkSession, sf: str) -> DataFrame:
    return reports.renovation_markers(_cycles(spark, sf), _lot_list(spark, sf))


def growth_lots(spark: SparkSession, sf: str) -> DataFrame:
    return reports.growth_lots(_cycles(spark, sf, "ndvi_corrected"))


def growth_curves(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored_cycles(spark, sf, "ndvi_corrected", "image_id")
    return reports.growth_curves(rows, reports.growth_sample(rows))


def sampled_renovations(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sampled_renovations(_cycles(spark, sf))


def renovated_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored_cycles(spark, sf)
    return reports.renovated_history(rows, reports.sampled_renovations(rows))


def values_at_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored_cycles(spark, sf)
    events = reports.renovated_harvests(rows)
    return reports.values_at_events(reports.renovated_history(rows, events, in_order=False), events)


def _flat(traces: DataFrame, cycle: str, *arrays: str, other: Sequence[Column] = ()) -> DataFrame:
    """Arrays as text, so that they compare in any engine, and ``other`` columns."""
    kinds = {n: "decimal(10,4)" for n in ("ndvi", "stac", "ref")}

    def text(name: str) -> Column:
        plain = F.col(name).cast(f"array<{kinds.get(name, 'string')}>")
        return F.array_join(plain.cast("array<string>"), ",", "null")

    joined = {a: text(a) for a in arrays}
    return traces.select(
        "lot_id",
        F.col(cycle).cast("string").alias("cycle"),
        "chunk",
        "color",
        *[c.alias(n) for n, c in joined.items()],
        *other,
    )


def history_traces(spark: SparkSession, sf: str) -> DataFrame:
    history = reports.lot_history(_cycles(spark, sf), _lot_list(spark, sf), in_order=False)
    return _flat(reports.history_traces(history), "cycle_end", "dates", "ndvi", "age", "copies")


def renovated_traces(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored_cycles(spark, sf)
    history = reports.renovated_history(rows, reports.renovated_harvests(rows), in_order=False)
    return _flat(reports.renovated_traces(history), "harvest", "dates", "ndvi", "age", "copies")


def growth_traces(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored_cycles(spark, sf, "ndvi_corrected", "image_id")
    curves = reports.growth_curves(rows, reports.growth_lots(rows), in_order=False)
    texts = F.array_join("images", ",").alias("images")
    return _flat(reports.growth_traces(curves), "harvest", "age", "stac", "ref", "dates", "copies", other=[texts])


def _feed(pieces: DataFrame) -> DataFrame:
    """Pieces with their place in the document; the first value of an array has no comma."""
    return pieces.select("lot_id", "section", "cycle", "field", "place", "text")


def lot_feed(spark: SparkSession, sf: str) -> DataFrame:
    rows, lots = _stored_cycles(spark, sf), _lot_list(spark, sf)
    return _feed(feeds.lot_feed(reports.lot_history(rows, lots, in_order=False), reports.renovation_markers(rows, lots)))


def growth_feed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored_cycles(spark, sf, "ndvi_corrected", "image_id")
    return _feed(feeds.growth_feed(reports.growth_curves(rows, reports.growth_lots(rows), in_order=False)))


def renovated_feed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored_cycles(spark, sf)
    events = reports.renovated_harvests(rows)
    history = reports.renovated_history(rows, events, in_order=False)
    return _feed(feeds.renovated_feed(history, reports.values_at_events(history, events)))


# --- cleaning, matching, calibration ----------------------------------------------------


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    """Both sources start from the same bands, which are stored in buckets by the columns they are matched on."""
    bands = stored(in_buckets(t.lot_bands(t.shipments(spark, sf)), "lot_id", "obs_date"))
    return matched_sources(t.reference_source(spark, sf, bands), t.scene_source(spark, sf, bands))


def _stored_matched(spark: SparkSession, sf: str) -> DataFrame:
    """Matched rows as a stored table, for queries that read them more than once."""
    return stored(_matched(spark, sf))


def _years(matched: DataFrame) -> list[int]:
    """One row per calendar year."""
    return sorted(r[0] for r in matched.select("year").distinct().collect())


def clean_index_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return clean_ranges(t.scene_source(spark, sf)).select(
        "lot_id", "obs_date", "ndvi_mean", "ndwi11_mean", "msi11_mean"
    )


def match_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf)


def residuals(spark: SparkSession, sf: str) -> DataFrame:
    rows = explore.residuals(_matched(spark, sf))
    return _rounded(rows.select("lot_id", "obs_date", "ndvi_residual", "ndwi11_residual", "msi11_residual"))


def matched_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = explore.matched_counts(_matched(spark, sf))
    years = F.array_join(F.transform("years", lambda y: y.cast("string")), ",")
    return counts.withColumn("years", years)


def source_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(explore.source_summary(_matched(spark, sf)))


def bias_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(explore.bias_by_year(_matched(spark, sf)))


def residual_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return explore.residual_histogram(_stored_matched(spark, sf))


def scatter_sample(spark: SparkSession, sf: str) -> DataFrame:
    sample = sampling.sample_rows(_matched(spark, sf), 2000, 42, ["lot_id", "obs_date"])
    return sample.select("lot_id", "obs_date", "ndvi_stac", "ndvi_ref")


def line_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(explore.line_fit(_matched(spark, sf)))


def identity_range(spark: SparkSession, sf: str) -> DataFrame:
    return explore.identity_range(_matched(spark, sf))


def ols_final(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibrate.fit_final(_matched(spark, sf)))


def ols_cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibrate.cross_validate(_stored_matched(spark, sf)))


def cross_validation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibrate.summarize_folds(calibrate.cross_validate(_stored_matched(spark, sf))))


def ols_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibrate.fit_holdout(_stored_matched(spark, sf), TEST_YEAR))


def huber_final(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibrate.fit_final_huber(_matched(spark, sf), "msi11"))


def huber_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibrate.fit_holdout_huber(_matched(spark, sf), "msi11", TEST_YEAR))


def huber_cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    matched = _stored_matched(spark, sf)
    return _rounded(calibrate.cross_validate_huber(matched, "msi11", _years(matched)))


def calibration(spark: SparkSession, sf: str) -> DataFrame:
    """Every index with its own model: final lines, lines of the hold-out and of all folds."""
    matched = _stored_matched(spark, sf)
    fits = calibrate_sources(matched, _years(matched), TEST_YEAR)
    line = ["index", "slope", "intercept"]
    none = F.lit(None).cast("int").alias("year")
    parts = [
        fits.final.select(F.lit("final").alias("part"), none, *line),
        fits.holdout.select(F.lit("holdout").alias("part"), none, *line),
        fits.folds.select(F.lit("fold").alias("part"), F.col("year").cast("int").alias("year"), *line),
    ]
    return _rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def apply_correction(spark: SparkSession, sf: str) -> DataFrame:
    return calibrate.apply_correction(_matched(spark, sf))


def corrected_observations(spark: SparkSession, sf: str) -> DataFrame:
    return calibrate.to_observations(calibrate.apply_correction(_matched(spark, sf)))


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Corrected rows written as CSV and read back as observations."""
    path = fresh_path(spark)
    writers.write_csv(calibrate.apply_correction(_matched(spark, sf)), path)
    return readers.read_observations_csv(spark, path)


def index_files_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Index means written per year and read back with the year of the folder."""
    path = fresh_path(spark)
    writers.write_indices(t.reference_source(spark, sf), path)
    return readers.read_reference(spark, path)


def scene_files(spark: SparkSession, sf: str) -> DataFrame:
    """Index means of scenes written by year and read back; the year is that of the date."""
    path = fresh_path(spark)
    writers.write_indices(t.scene_source(spark, sf), path)
    return readers.read_scene_indices(spark, path)


def united_years(spark: SparkSession, sf: str) -> DataFrame:
    """The folders of three years read as one table."""
    path = fresh_path(spark)
    writers.write_indices(t.reference_source(spark, sf), path)
    return readers.read_reference(spark, path, [1995, 1997, 1998])


def listed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Years of the Parquet files found below a folder."""
    path = fresh_path(spark)
    writers.write_indices(t.reference_source(spark, sf), path)
    files = readers.read_manifest(spark, path, ".parquet")
    return files.where("length > 0").select(readers.folder_year(F.col("path")).alias("year")).distinct()


def factor_files(spark: SparkSession, sf: str) -> DataFrame:
    """Both factor sets written as JSON and read back."""
    matched, path = _stored_matched(spark, sf), fresh_path(spark)
    validation = calibrate.fit_holdout(matched, TEST_YEAR).select("index", "slope", "intercept")
    writers.write_factors(calibrate.fit_final(matched), validation, path)
    sets = [readers.read_factors(spark, path, name).withColumn("part", F.lit(name)) for name in ("final", "validation_1")]
    return _rounded(sets[0].unionByName(sets[1]))


def table_as_select(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is replaced by the result of a query."""
    name = f"lotseries_{uuid.uuid4().hex}"
    rows = t.master(spark, sf).select("lot_id", "obs_date", "season", "harvest", "tch")
    writers.write_table(t.observations(spark, sf).select("lot_id"), name)
    writers.write_table(rows, name)
    found = stored(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    return found


def history_by_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """A SQL text with a list and a number as parameters; the lots are those of `_lot_list`."""
    view = f"observations_{uuid.uuid4().hex}"
    t.observations(spark, sf).createOrReplaceTempView(view)
    sql = f"SELECT lot_id, obs_date, ndvi_ref FROM {view} WHERE array_contains(:lots, lot_id) AND ndvi_ref >= :low"
    return readers.read_query(spark, sql, lots=[str(k) for k in range(1, 60, 2)], low=0.1)


def difference_summary(spark: SparkSession, sf: str) -> DataFrame:
    corrected = calibrate.apply_correction(_matched(spark, sf))
    return _rounded(calibrate.difference_summary(corrected))


# --- rasters --------------------------------------------------------------------------


def index_algebra(spark: SparkSession, sf: str) -> DataFrame:
    items = t.table(spark, sf, "lineitem")
    red = F.col("l_quantity") * 500 - F.when(F.col("l_returnflag") == "R", 2500).otherwise(0)
    swir = F.col("l_quantity") * (F.col("l_discount") * 5000 + 200)
    values = spectral_indices(F.col("l_extendedprice"), red, swir)
    return items.select("l_orderkey", "l_linenumber", "l_partkey", *[c.alias(n) for n, c in values.items()])


def affine_pixels(spark: SparkSession, sf: str) -> DataFrame:
    rotated = {n: F.lit(v) for n, v in zip("abcdef", (9.5, 0.75, 500000.0, 0.5, -10.25, 1600000.0))}
    x, y = pixel_center(F.col("col"), F.col("row"), rotated)
    return t.patch_pixels(spark, sf).select("vec_id", "row", "col", x.alias("x"), y.alias("y"))


def zonal_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = raster.zonal_stats(t.mosaic(spark, sf), t.mosaic_lots(spark, sf), ["value"])
    return _rounded(stats.drop("scene_id", "lot_id"))


def pooled_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics per (supplier, part), pooled per supplier."""
    v = F.col("l_quantity") / F.col("l_extendedprice")
    parts = t.table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        F.count(v).alias("v_count"),
        F.avg(v).alias("v_mean"),
        F.max(v).alias("v_max"),
        F.min(v).alias("v_min"),
        F.stddev_pop(v).alias("v_std"),
    )
    pooled = raster.pool_stats(parts, ["l_suppkey"], ["v"])
    return raster.finalize_stats(pooled, ["v"], DIGITS)


def clip_window(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels within the bounds of every lot, read from a store of small blocks."""
    pixels, path = t.mosaic(spark, sf).select("scene_id", "row", "col"), fresh_path(spark)
    pixel_store.write_pixels(pixels, path, WINDOW_BLOCK)
    bounds = catalog.total_bounds(t.mosaic_lots(spark, sf), ["scene_id", "lot_id"])
    stored_pixels = pixel_store.read_pixels(spark, path, pixels.schema)
    placed = bounds.select("*", *t.grid(F.lit(0.25), F.lit(-0.5)))
    clipped = raster.clip_pixels(stored_pixels, placed, block=WINDOW_BLOCK, keep=["lot_id"])
    return clipped.select("lot_id", "row", "col")


def bilinear_resample(spark: SparkSession, sf: str) -> DataFrame:
    """Each 8 x 8 patch on a grid of 16 x 16."""
    pixels = t.patch_pixels(spark, sf)
    coarse = pixels.select(
        F.col("vec_id").alias("scene_id"),
        (F.col("row") % t.PATCH).alias("row"),
        (F.col("col") % t.PATCH).alias("col"),
        "value",
    )
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    fine = coarse.select("scene_id", "row", "col", F.inline(offsets)).select(
        "scene_id",
        (F.col("row") * 2 + F.col("i")).alias("row"),
        (F.col("col") * 2 + F.col("j")).alias("col"),
        *[c.alias(f"fine_{n}") for n, c in zip("abcdef", t.grid(F.lit(0.0), F.lit(0.0), 0.5))],
        *[c.alias(f"coarse_{n}") for n, c in zip("abcdef", t.grid(F.lit(0.0), F.lit(0.0), 1.0))],
    )
    return _rounded(raster.resample_bilinear(fine, coarse))


def extract_scenes(spark: SparkSession, sf: str) -> DataFrame:
    lots = t.lots(spark, sf).withColumn("obs_date", F.lit("2024-01-01").cast("date"))
    return extraction.extract_scene_indices(
        lots,
        t.scene_catalogue(spark, sf),
        t.scene_bands(spark, sf),
        t.scene_transforms(spark, sf),
    )


def extract_rasters(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.extract_raster_indices(
        t.raster_files(spark, sf),
        t.raster_lots(spark, sf),
        t.raster_pixels(spark, sf),
        t.raster_transforms(spark, sf),
    )


def lot_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return raster.coverage(extract_rasters(spark, sf))


def lot_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lots written without and with a lot column, and read back: only without does the polygon stand in."""
    plain, named = fresh_path(spark), fresh_path(spark)
    lots = t.lots(spark, sf)
    lots.drop("lot_id").write.parquet(plain)
    lots.withColumnRenamed("lot_id", "cod_cg").write.parquet(named)
    both = [("plain", readers.read_lots(spark, plain, "cod_cg")), ("named", readers.read_lots(spark, named, "cod_cg"))]
    corners = F.size(F.flatten("rings")).alias("corners")
    parts = [df.select(F.lit(kind).alias("kind"), "polygon_id", "lot_id", corners) for kind, df in both]
    return parts[0].unionByName(parts[1])


def pixel_files(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels written in one folder per scene and read back."""
    path = fresh_path(spark)
    pixels = t.scene_bands(spark, sf)
    pixels.hint("rebalance", "scene_id").write.partitionBy("scene_id").parquet(path)
    return readers.read_pixels(spark, path)


# --- scenes ---------------------------------------------------------------------------


def total_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.total_bounds(t.dated_lots(spark, sf), ["obs_date"])


def search_scenes(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.search_scenes(t.catalogue(spark, sf), t.dated_lots(spark, sf))
    return found.select("scene_id", "obs_date", "cloud_cover")


def best_scene(spark: SparkSession, sf: str) -> DataFrame:
    month = F.trunc("datetime", "month")
    scenes = t.catalogue(spark, sf).withColumn("month", month)
    return catalog.best_scene_per_tile(scenes, ["month"]).select(
        "month", "tile", "scene_id", "cloud_cover", "tile_order"
    )


def required_assets(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.with_required_assets(t.catalogue(spark, sf)).select("scene_id", "pos")


def _lots_and_tiles(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lots = stored(t.dated_lots(spark, sf))
    scenes = extraction.choose_scenes(lots, t.catalogue(spark, sf))
    return lots, stored(scenes.select("obs_date", "scene_id", "tile", "tile_order", *catalog.BOX))


def lots_in_tiles(spark: SparkSession, sf: str) -> DataFrame:
    pairs = catalog.lots_touching_tiles(*_lots_and_tiles(spark, sf), ["obs_date"])
    return pairs.select("obs_date", "polygon_id", "scene_id")


def tile_assignment(spark: SparkSession, sf: str) -> DataFrame:
    lots, tiles = _lots_and_tiles(spark, sf)
    pairs = catalog.lots_touching_tiles(lots, tiles, ["obs_date"])
    assigned = catalog.assign_first_tile(pairs, lots, tiles, ["obs_date"])
    return assigned.select("obs_date", "polygon_id", "lot_id", "scene_id", "tile")


def ring_box(spark: SparkSession, sf: str) -> DataFrame:
    box = polygon_bounds(F.col("rings"))
    return t.lots(spark, sf).select("polygon_id", *[c.alias(n) for n, c in box.items()])


# --- manifest -------------------------------------------------------------------------


def classified_assets(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.classify_assets(t.manifest(spark, sf)).select("path", "parent", "date", "kind")


def latest_asset(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.latest_asset(manifest.classify_assets(t.manifest(spark, sf)))


def complete_dates(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.complete_dates(manifest.classify_assets(t.manifest(spark, sf)))


def skipped_dates(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.skipped_dates(manifest.classify_assets(t.manifest(spark, sf)))


def discovered_years(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.discover_years(t.manifest(spark, sf), "Reference", "-raster")


def first_files(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.select_files(t.manifest(spark, sf).distinct(), ".shp", limit=100)


def companion_files(spark: SparkSession, sf: str) -> DataFrame:
    found = manifest.companion_files(t.manifest(spark, sf), ".tif")
    return found.select("folder", "stem", F.array_join("extensions", ",").alias("extensions"))


def distinct_stems(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.distinct_stems(t.manifest(spark, sf))


# --- HTML reports ---------------------------------------------------------------------


def html_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = report_html.page_rows(t.table(spark, sf, "pages"), "page_id", row_tag="ul", cell_tags="li")
    return rows.select("page_id", F.posexplode("cells").alias("cell_no", "cell"))


def html_table(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of the pages as a table of eight columns: long rows are cut, short ones padded, blank cells null."""
    rows = report_html.page_rows(t.table(spark, sf, "pages"), "page_id", row_tag="ul", cell_tags="li")
    return report_html.to_columns(rows, [f"c{i}" for i in range(8)], ["page_id"])


def slug_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Column names of the page headings."""
    heading = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return t.table(spark, sf, "pages").select("page_id", slug_column(heading).alias("slug"))


def numeric_inference(spark: SparkSession, sf: str) -> DataFrame:
    """Types of the columns of `orders` and `customer` when read as text."""
    table = t.table(spark, sf, "orders").join(
        t.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    names = [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_name", "c_acctbal", "c_nationkey",
    ]
    text = table.select(*[F.col(n).cast("string") for n in names])
    with_units = text.withColumn("o_custkey", F.concat("o_custkey", F.lit("d")))
    return report_html.column_types(with_units, names)


def report_ingest(spark: SparkSession, sf: str) -> DataFrame:
    rows = report_html.page_rows(t.report_rows(spark, sf), "file")
    return report_html.parse_report(rows, ["file", "pos"], min_cells=5)


def report_file(spark: SparkSession, sf: str) -> DataFrame:
    """The report written as files and read back by byte ranges."""
    path = fresh_path(spark)
    t.report_file(spark, sf, path)
    return report_html.read_report(spark, path, min_cells=5)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        season_keys, yield_keys, master_left_join, age_since_known_harvest,
        age_since_previous_season, age_with_ratoon, season_gap_flags, season_gaps, rollback_age,
        next_harvest, cycle_age, renovation_events, valid_cycles, repaired_cycles,
        repaired_table,
        ml_dataset, dataset_size, cycle_length_buckets, renovation_report, lot_history,
        renovation_markers, growth_lots, growth_curves, sampled_renovations, renovated_history,
        values_at_events, history_traces, renovated_traces, growth_traces,
        lot_feed, growth_feed, renovated_feed,
        clean_index_ranges, match_sources, residuals, matched_counts, source_summary,
        bias_by_year, residual_histogram, scatter_sample, line_fit, identity_range,
        ols_final, ols_cross_validation, cross_validation_summary, ols_holdout,
        huber_final, huber_holdout, huber_cross_validation, apply_correction, corrected_observations, csv_round_trip,
        index_files_round_trip, difference_summary,
        index_algebra, affine_pixels, zonal_stats, pooled_stats, clip_window, bilinear_resample,
        extract_scenes, extract_rasters, lot_coverage,
        total_bounds, search_scenes, best_scene, required_assets, lots_in_tiles, tile_assignment,
        ring_box, classified_assets, latest_asset, complete_dates, skipped_dates,
        discovered_years, first_files, companion_files, distinct_stems,
        html_cells, html_table, slug_columns, numeric_inference, report_ingest, report_file,
        scene_files, united_years, listed_files, factor_files, table_as_select, history_by_parameters,
        calibration, lot_files, pixel_files,
    )
}
