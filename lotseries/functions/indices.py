"""Index algebra and value cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_difference(a: Column, b: Column) -> Column:
    """``(a - b) / (a + b)`` where both bands are positive, else null."""
    a, b = a.cast("double"), b.cast("double")
    return F.when((a > 0) & (b > 0), (a - b) / (a + b))


def band_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where both bands are positive, else null."""
    n, d = numerator.cast("double"), denominator.cast("double")
    return F.when((n > 0) & (d > 0), n / d)


def within(value: Column, low: float, high: float) -> Column:
    """The value if it lies in [low, high]; null for anything else, NaN and infinities too."""
    return F.when(value.between(low, high), value)


def spectral_indices(nir: Column, red: Column, swir: Column) -> dict[str, Column]:
    """The three indices of a pixel, by name."""
    return {
        "ndvi": normalized_difference(nir, red),
        "ndwi11": normalized_difference(nir, swir),
        "msi11": band_ratio(swir, nir),
    }
