"""Operators over a file manifest: one row per file, column ``path``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotseries.functions.text import first_date

# Name fragment of each raster kind, tested in this order.
RASTER_KINDS = {"ndvi": "01-NDVI_", "ndwi11": "02-NDWI-11_", "msi11": "04-MSI-11_"}
LOTS_KIND = "lots"


def describe_files(manifest: DataFrame) -> DataFrame:
    """Add name, stem, extension, parent folder name and the date in the file name."""
    name = F.element_at(F.split("path", "/"), -1)
    return manifest.withColumns(
        {
            "name": name,
            "stem": F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""),
            "extension": F.regexp_extract(name, r".(\.[^.]*)$", 1),
            "parent": F.get(F.reverse(F.split("path", "/")), F.lit(1)),
            "date": first_date(name),
        }
    )


def classify_assets(manifest: DataFrame) -> DataFrame:
    """Keep dated rasters and lot files and add their ``kind``; suffixes are case-sensitive."""
    files = describe_files(manifest)
    kind = F.when(F.col("name").endswith(".shp"), LOTS_KIND)
    for label, fragment in RASTER_KINDS.items():
        is_kind = F.col("name").endswith(".tif") & F.col("name").contains(fragment)
        kind = kind.when(is_kind, label)
    return files.withColumn("kind", kind).where("kind is not null and date is not null")


def latest_asset(assets: DataFrame) -> DataFrame:
    """One file per kind and date: the last path in sort order."""
    return assets.groupBy("date", "kind").agg(F.max("path").alias("path"))


def assets_by_date(assets: DataFrame) -> DataFrame:
    """One row per date with the path of every kind, null where it is missing."""
    kinds = [*RASTER_KINDS, LOTS_KIND]
    paths = [F.max(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in kinds]
    return assets.groupBy("date").agg(*paths)


def complete_dates(assets: DataFrame) -> DataFrame:
    """Dates that have all three rasters and a lot file."""
    return assets_by_date(assets).dropna(subset=[*RASTER_KINDS, LOTS_KIND])


def skipped_dates(assets: DataFrame) -> DataFrame:
    """Dates with at least one raster for which something is missing."""
    by_date = assets_by_date(assets)
    some = F.coalesce(*[F.col(k) for k in RASTER_KINDS]).isNotNull()
    every = [F.col(k).isNotNull() for k in [*RASTER_KINDS, LOTS_KIND]]
    complete = every[0] & every[1] & every[2] & every[3]
    return by_date.where(some & ~complete).select("date")


def discover_years(manifest: DataFrame, root: str, suffix: str = "") -> DataFrame:
    """Years among the folders directly under ``root``: digits followed by ``suffix``."""
    pattern = rf"(?:^|/)\Q{root.strip('/')}\E/(\d+)\Q{suffix}\E/"
    year = F.regexp_extract("path", pattern, 1)
    return manifest.select(year.alias("year")).where("year <> ''").distinct().orderBy("year")


def select_files(
    manifest: DataFrame,
    suffix: str,
    years: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Files with a suffix, of some years if given, the first ``limit`` by path if given."""
    files = manifest.where(F.col("path").endswith(suffix))
    if years is not None:
        files = files.where(F.element_at(F.split("path", "/"), -2).isin(years))
    files = files.orderBy("path")
    return files if limit is None else files.limit(limit)


def companion_files(manifest: DataFrame, main_extension: str = ".shp") -> DataFrame:
    """Main files with the extensions found next to them under the same stem.

    Extensions per stem are few, so the set stays small whatever the manifest size.
    """
    files = describe_files(manifest).withColumn(
        "folder", F.regexp_replace("path", r"[^/]*$", "")
    )
    return (
        files.groupBy("folder", "stem")
        .agg(F.array_sort(F.collect_set("extension")).alias("extensions"))
        .where(F.array_contains("extensions", main_extension))
    )


def distinct_stems(manifest: DataFrame) -> DataFrame:
    """One file per stem, so that a file shared by several dates is read once."""
    return describe_files(manifest).groupBy("stem").agg(F.min("path").alias("path"))
