"""Calibration job: match two sources, fit, score, store factors, apply them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from lotseries.operators import calibrate
from lotseries.operators.matching import clean_ranges, match_sources
from lotseries.sources.readers import factor_dict
from lotseries.sources.stored import stored
from lotseries.sources.writers import write_csv, write_factors

HOLDOUT_YEAR = 2025


@dataclass
class Calibration:
    """Scores and factors; every field is a table of a few rows."""

    holdout: DataFrame
    folds: DataFrame
    final: DataFrame


def matched_sources(ref: DataFrame, stac: DataFrame) -> DataFrame:
    return match_sources(clean_ranges(ref), clean_ranges(stac))


def calibrate_sources(
    matched: DataFrame, years: list[int], holdout_year: int = HOLDOUT_YEAR
) -> Calibration:
    """Fit and score every index with its model.

    The matched rows are stored first: every score reads them again.
    """
    ols = [i for i, m in calibrate.INDEX_MODELS.items() if m == "ols"]
    robust = [i for i, m in calibrate.INDEX_MODELS.items() if m == "huber"]
    known = stored(matched.where(matched.year.isin(years)))
    holdout = calibrate.fit_holdout(known, holdout_year, ols)
    folds = calibrate.cross_validate(known, ols)
    final = calibrate.fit_final(known, ols)
    for i in robust:
        holdout = holdout.unionByName(calibrate.fit_holdout_huber(known, i, holdout_year))
        folds = folds.unionByName(calibrate.cross_validate_huber(known, i, years))
        final = final.unionByName(calibrate.fit_final_huber(known, i))
    return Calibration(holdout, folds, final)


def run(
    ref: DataFrame,
    stac: DataFrame,
    years: list[int],
    factors_path: str,
    observations_path: str,
    holdout_year: int = HOLDOUT_YEAR,
) -> Calibration:
    """Store both factor sets and the observations corrected by the hold-out fit."""
    matched = stored(matched_sources(ref, stac))
    fits = calibrate_sources(matched, years, holdout_year)
    validation = fits.holdout.select("index", "slope", "intercept")
    write_factors(fits.final, validation, factors_path)
    corrected = calibrate.apply_correction(matched, factor_dict(validation))
    write_csv(corrected, observations_path)
    return fits
