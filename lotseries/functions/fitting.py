"""Straight-line fits from mergeable moments.

Moments of a group are ``n, mx, my, sxx, syy, sxy`` (count, means and centred
sums). They merge exactly, so training sets made of several groups need no
second pass over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MOMENTS = ["n", "mx", "my", "sxx", "syy", "sxy"]


def moments(x: Column, y: Column) -> Column:
    """Moments of the complete pairs of a group of rows."""
    return F.struct(
        F.regr_count(y, x).alias("n"),
        F.regr_avgx(y, x).alias("mx"),
        F.regr_avgy(y, x).alias("my"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
    )


def merge_moments(m: Column) -> Column:
    """Array of moments -> moments of the union. Means first, then the centred sums."""
    parts = F.filter(m, lambda p: p["n"] > 0)
    zero = F.lit(0.0)

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda acc, v: acc + v)

    n = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
    count = F.nullif(n, F.lit(0).cast("long"))
    mx = total(F.transform(parts, lambda p: p["n"] * p["mx"])) / count
    my = total(F.transform(parts, lambda p: p["n"] * p["my"])) / count

    def centred(s: str, u: tuple[str, Column], v: tuple[str, Column]) -> Column:
        return total(
            F.transform(parts, lambda p: p[s] + p["n"] * (p[u[0]] - u[1]) * (p[v[0]] - v[1]))
        )

    x, y = ("mx", mx), ("my", my)
    return F.struct(
        n.alias("n"),
        mx.alias("mx"),
        my.alias("my"),
        centred("sxx", x, x).alias("sxx"),
        centred("syy", y, y).alias("syy"),
        centred("sxy", x, y).alias("sxy"),
    )


def slope(m: Column) -> Column:
    return m["sxy"] / F.nullif(m["sxx"], F.lit(0.0))


def intercept(m: Column) -> Column:
    return m["my"] - slope(m) * m["mx"]


def squared_error(m: Column, a: Column, b: Column) -> Column:
    """Sum of ``(y - (a*x + b))**2`` over the rows behind the moments."""
    shift = m["my"] - a * m["mx"] - b
    return m["syy"] - 2 * a * m["sxy"] + a * a * m["sxx"] + m["n"] * shift * shift


def r_squared(m: Column, a: Column, b: Column) -> Column:
    """``1 - SSres / SStot`` against the group's own mean."""
    return 1 - squared_error(m, a, b) / F.nullif(m["syy"], F.lit(0.0))
