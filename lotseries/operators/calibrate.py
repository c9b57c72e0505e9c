"""Linear correction of one source to another: fits, scores and application.

Ordinary least squares never revisits the rows to fit: one grouped pass yields
mergeable moments per index and year, and every training set (all years, all
but one, the hold-out) is a merge of those few rows. Only the mean absolute
error needs a second pass, with the coefficients joined to the rows by year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.functions import fitting
from lotseries.operators.explore import by_index
from lotseries.schema import INDICES, OBSERVATION_COLUMNS
from lotseries.sources.stored import release, stored

# Model of each index.
INDEX_MODELS = {"ndvi": "ols", "ndwi11": "ols", "msi11": "huber"}
# The usual defaults of the robust fit.
HUBER_EPSILON = 1.35
HUBER_ALPHA = 1e-4
# Published coefficients of the hold-out fit.
VALIDATION_FACTORS = {
    "ndvi": {"slope": 0.8334753900735666, "intercept": 0.0069342589939932475},
    "ndwi11": {"slope": 0.8970826750876867, "intercept": 0.10129756238928883},
    "msi11": {"slope": 0.7499135531008353, "intercept": 0.05783716382847559},
}

def complete_pairs(matched: DataFrame, index: str) -> DataFrame:
    """``year, x, y`` of the rows that have both values."""
    return matched.select(
        "year",
        F.col(f"{index}_stac").cast("double").alias("x"),
        F.col(f"{index}_ref").cast("double").alias("y"),
    ).dropna(subset=["x", "y"])


def yearly_moments(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Moments of the complete pairs per index and year."""
    return by_index(
        matched,
        lambda i: {"moments": fitting.moments(F.col(f"{i}_stac"), F.col(f"{i}_ref"))},
        indices,
        ["year"],
    )


def _coefficients(train: Column) -> list[Column]:
    return [fitting.slope(train).alias("slope"), fitting.intercept(train).alias("intercept")]


def fit_final(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Least-squares line per index over all years."""
    train = fitting.merge_moments(F.collect_list("moments")).alias("train")
    moments = yearly_moments(matched, indices)
    return moments.groupBy("index").agg(train).select("index", *_coefficients(F.col("train")))


def _fold_lines(moments: DataFrame) -> DataFrame:
    """One row per index and test year: line fitted on the other years, moments of the year."""
    others = F.filter("folds", lambda f: f["year"] != F.col("fold.year"))
    train = fitting.merge_moments(F.transform(others, lambda f: f["moments"]))
    # a handful of years per index: the arrays below are tiny whatever the data size
    folds = moments.groupBy("index").agg(
        F.collect_list(F.struct("year", "moments")).alias("folds")
    )
    lines = folds.select("index", "folds", F.explode("folds").alias("fold")).select(
        "index",
        F.col("fold.year").alias("year"),
        F.col("fold.moments").alias("test"),
        train.alias("train"),
    )
    return lines.select("index", "year", "test", *_coefficients(F.col("train")))


def _absolute_errors(matched: DataFrame, lines: DataFrame, indices: Sequence[str]) -> DataFrame:
    """Mean absolute error per index and year, given one line per index and year."""
    wide = lines.groupBy("year").agg(
        *[
            F.max(F.when(F.col("index") == i, F.struct("slope", "intercept"))).alias(i)
            for i in indices
        ]
    )

    def measures(i: str) -> dict[str, Column]:
        guess = F.col(f"{i}.slope") * F.col(f"{i}_stac") + F.col(f"{i}.intercept")
        return {"mae": F.avg(F.abs(F.col(f"{i}_ref") - guess))}

    # one row per calendar year on the right side
    return by_index(matched.join(F.broadcast(wide), "year"), measures, indices, ["year"])


def cross_validate(matched: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Leave-one-year-out scores of the least-squares line, one row per index and year."""
    lines = _fold_lines(yearly_moments(matched, indices).where("year is not null"))
    errors = _absolute_errors(matched, lines.select("index", "year", "slope", "intercept"), indices)
    return lines.join(errors, ["index", "year"]).select(
        "index",
        "year",
        F.col("test.n").alias("n"),
        "slope",
        "intercept",
        fitting.r_squared(F.col("test"), F.col("slope"), F.col("intercept")).alias("r2"),
        "mae",
    )


def summarize_folds(folds: DataFrame) -> DataFrame:
    """Mean and population std of the fold scores per index."""
    return folds.groupBy("index").agg(
        F.avg("r2").alias("r2_mean"),
        F.stddev_pop("r2").alias("r2_std"),
        F.avg("mae").alias("mae_mean"),
        F.stddev_pop("mae").alias("mae_std"),
    )


def fit_holdout(
    matched: DataFrame, test_year: int, indices: Sequence[str] = INDICES
) -> DataFrame:
    """Line fitted without a year, scored on the training years and on that year."""
    is_test = F.col("year") == test_year
    parts = yearly_moments(matched, indices).where("year is not null").groupBy("index").agg(
        fitting.merge_moments(F.collect_list(F.when(~is_test, F.col("moments")))).alias("train"),
        fitting.merge_moments(F.collect_list(F.when(is_test, F.col("moments")))).alias("test"),
    )
    lines = parts.select("*", *_coefficients(F.col("train")))
    by_part = lines.select("index", "slope", "intercept", F.explode(F.array(F.lit(0), F.lit(1))).alias("year"))
    split = matched.where("year is not null").withColumn("year", is_test.cast("int"))
    errors = _absolute_errors(split, by_part, indices)
    mae = errors.groupBy("index").agg(
        F.max(F.when(F.col("year") == 0, F.col("mae"))).alias("train_mae"),
        F.max(F.when(F.col("year") == 1, F.col("mae"))).alias("test_mae"),
    )
    line = (F.col("slope"), F.col("intercept"))
    return lines.join(mae, "index").select(
        "index",
        "slope",
        "intercept",
        F.col("train.n").alias("train_n"),
        fitting.r_squared(F.col("train"), *line).alias("train_r2"),
        "train_mae",
        F.col("test.n").alias("test_n"),
        fitting.r_squared(F.col("test"), *line).alias("test_r2"),
        "test_mae",
    )


# --- robust fit -----------------------------------------------------------------------
#
# A training set is "all years but one" or "all years". Every pass over the rows serves all
# training sets at once: it splits the rows of each set into near and far ones by the set's
# current line and scale, and sums them up per set. The driver then solves the (convex)
# problem for that split, which needs the sums only. The split settles after a few passes.

Line = tuple[float | None, float | None]

# More passes than any convergent fit takes; beyond, the fit fails rather than answer with something else.
HUBER_MAX_PASSES = 1_000
HUBER_LEAST_SCALE = 1e-12
HUBER_TOLERANCE = 1e-10


def _split_sums(pairs: DataFrame, lines: dict[int | None, tuple[float, float, float]]) -> DataFrame:
    """Sums of the near rows, and signs of the far ones, per training set.

    The lines enter as one array, so the generated code is the same in each pass.
    """
    sets = [
        F.struct(
            F.lit(left_out).cast("int").alias("left_out"),
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            F.lit(HUBER_EPSILON * scale).alias("reach"),
        )
        for left_out, (a, b, scale) in lines.items()
    ]
    x, y = F.col("x"), F.col("y")
    rows = pairs.select("year", "x", "y", F.inline(F.array(*sets)))
    used = rows.where("left_out is null or year <> left_out").withColumn(
        "rest", y - (F.col("a") * x + F.col("b"))
    )
    near, side = F.abs("rest") <= F.col("reach"), F.signum("rest")
    sums = {
        "n": F.count(F.when(near, 1)),
        "x": F.sum(F.when(near, x)),
        "y": F.sum(F.when(near, y)),
        "xx": F.sum(F.when(near, x * x)),
        "xy": F.sum(F.when(near, x * y)),
        "yy": F.sum(F.when(near, y * y)),
        "far": F.count(F.when(~near, 1)),
        "side": F.sum(F.when(~near, side)),
        "side_x": F.sum(F.when(~near, side * x)),
    }
    return used.groupBy("left_out").agg(
        *[F.coalesce(c, F.lit(0)).cast("double").alias(n) for n, c in sums.items()]
    )


def _solve_split(s: dict[str, float], scale: float) -> tuple[float, float, float] | None:
    """Minimum of the Huber objective while near and far rows stay as they are."""
    dof = s["n"] + s["far"] - HUBER_EPSILON**2 * s["far"]
    if dof <= 0 or s["n"] == 0:
        return None
    for _ in range(500):
        xx = s["xx"] + HUBER_ALPHA * scale
        rhs_x = s["xy"] + scale * HUBER_EPSILON * s["side_x"]
        rhs_1 = s["y"] + scale * HUBER_EPSILON * s["side"]
        det = xx * s["n"] - s["x"] * s["x"]
        if det <= 0:
            return None
        a = (rhs_x * s["n"] - rhs_1 * s["x"]) / det
        b = (rhs_1 * xx - rhs_x * s["x"]) / det
        near = s["yy"] - 2 * a * s["xy"] - 2 * b * s["y"] + a * a * s["xx"] + 2 * a * b * s["x"] + b * b * s["n"]
        new = max((max(near, 0.0) / dof) ** 0.5, HUBER_LEAST_SCALE)
        if abs(new - scale) <= 1e-14 * max(new, 1e-300):
            break
        scale = new
    return a, b, new


def fit_huber_lines(
    pairs: DataFrame, left_out: Sequence[int | None]
) -> dict[int | None, Line]:
    """Huber lines of ``x, y``, each without the rows of one year (None: with all rows).

    A training set without rows has a line of nulls.

    ``pairs`` should be stored. Only sums come to the driver: nine numbers per
    training set and pass.
    """
    by_year = pairs.groupBy("year").agg(fitting.moments(F.col("x"), F.col("y")).alias("m"))
    years = [F.struct(F.lit(y).cast("int").alias("left_out")) for y in left_out]
    starts = (
        by_year.select("year", "m", F.inline(F.array(*years)))
        .where("left_out is null or year <> left_out")
        .groupBy("left_out")
        .agg(fitting.merge_moments(F.collect_list("m")).alias("m"))
        .collect()
    )
    starts = [start for start in starts if start["m"]["n"]]
    if not starts:
        return dict.fromkeys(left_out, (None, None))
    # shifted values keep the plain sums accurate
    x0, y0 = starts[0]["m"]["mx"], starts[0]["m"]["my"]
    shifted = pairs.withColumns({"x": F.col("x") - x0, "y": F.col("y") - y0})
    lines = {}
    for start in starts:
        m = start["m"]
        a = m["sxy"] / m["sxx"] if m["sxx"] else 0.0
        spread = max(m["syy"] - a * m["sxy"], 0.0) / max(m["n"], 1)
        line = (a, m["my"] - y0 - a * (m["mx"] - x0), max(spread**0.5, 1e-9))
        lines[start["left_out"]] = line
    active = dict(lines)
    for _ in range(HUBER_MAX_PASSES):
        for row in _split_sums(shifted, active).collect():
            key = row["left_out"]
            solved = _solve_split(row.asDict(), lines[key][2])
            if solved is None:  # too few near rows at this scale
                a, b, scale = lines[key]
                lines[key] = active[key] = (a, b, 2 * scale)
                continue
            moved = max(abs(p - q) for p, q in zip(solved, lines[key]))
            lines[key] = active[key] = solved
            if moved <= HUBER_TOLERANCE * max(1.0, abs(solved[0])):
                del active[key]
        if not active:
            fitted = {k: (a, b + y0 - a * x0) for k, (a, b, _) in lines.items()}
            return {k: fitted.get(k, (None, None)) for k in left_out}
    raise ArithmeticError(f"robust fit without {sorted(active, key=str)} has not settled")


def _score(pairs: DataFrame, by: Column, a: Column, b: Column) -> DataFrame:
    """Scores per part of the rows; ``a`` and ``b`` are functions of the part."""
    m = F.col("m")
    parts = pairs.withColumn("part", by).withColumns({"a": a, "b": b})
    return (
        parts.groupBy("part", "a", "b")
        .agg(
            fitting.moments(F.col("x"), F.col("y")).alias("m"),
            F.avg(F.abs(F.col("y") - (F.col("a") * F.col("x") + F.col("b")))).alias("mae"),
        )
        .select(
            "part",
            F.col("a").alias("slope"),
            F.col("b").alias("intercept"),
            m["n"].alias("n"),
            fitting.r_squared(m, F.col("a"), F.col("b")).alias("r2"),
            "mae",
        )
    )


def _fit_each(pairs: DataFrame, left_out: Sequence[int | None]) -> tuple[DataFrame, dict[int | None, Line]]:
    """Robust fits; the pairs are stored, for the passes of the fits and for the scores after them."""
    held = stored(pairs)
    return held, fit_huber_lines(held, left_out)


def cross_validate_huber(matched: DataFrame, index: str, years: Sequence[int]) -> DataFrame:
    """Leave-one-year-out scores of the robust line: fits side by side, one scoring pass."""
    pairs = complete_pairs(matched, index).where(F.col("year").isin(list(years)))
    pairs, lines = _fit_each(pairs, list(years))

    def coefficient(k: int) -> Column:
        by_year = F.create_map(*[v for y in years for v in (F.lit(y), F.lit(lines[y][k]).cast("double"))])
        return F.element_at(by_year, F.col("part"))

    scores = _score(pairs, F.col("year").cast("int"), coefficient(0), coefficient(1))
    return scores.select(
        F.lit(index).alias("index"),
        F.col("part").alias("year"),
        "n",
        "slope",
        "intercept",
        "r2",
        "mae",
    )


def fit_holdout_huber(matched: DataFrame, index: str, test_year: int) -> DataFrame:
    """``fit_holdout`` with the robust line."""
    pairs = complete_pairs(matched, index).where("year is not null")
    is_test = F.col("year") == test_year
    pairs, lines = _fit_each(pairs, [test_year])
    line = lines[test_year]
    scores = _score(pairs, is_test.cast("int"), F.lit(line[0]).cast("double"), F.lit(line[1]).cast("double"))

    def of(part: int, name: str) -> Column:
        return F.max(F.when(F.col("part") == part, F.col(name)))

    return scores.agg(
        F.lit(index).alias("index"),
        F.lit(line[0]).cast("double").alias("slope"),
        F.lit(line[1]).cast("double").alias("intercept"),
        *[
            of(part, name).alias(f"{label}_{name}")
            for part, label in ((0, "train"), (1, "test"))
            for name in ("n", "r2", "mae")
        ],
    )


def fit_final_huber(matched: DataFrame, index: str) -> DataFrame:
    """``fit_final`` with the robust line."""
    pairs, lines = _fit_each(complete_pairs(matched, index), [None])
    line = lines[None]
    release(pairs)
    return matched.sparkSession.range(1).select(
        F.lit(index).alias("index"),
        F.lit(line[0]).cast("double").alias("slope"),
        F.lit(line[1]).cast("double").alias("intercept"),
    )


# --- application ----------------------------------------------------------------------

Factors = dict[str, dict[str, float]]


def apply_correction(matched: DataFrame, factors: Factors = VALIDATION_FACTORS) -> DataFrame:
    """Corrected value, reference value and their difference for every index."""
    out = []
    for i, line in factors.items():
        corrected = F.lit(line["slope"]) * F.col(f"{i}_stac") + F.lit(line["intercept"])
        ref = F.col(f"{i}_ref")
        out += [
            corrected.alias(f"{i}_corrected"),
            ref.alias(f"{i}_ref"),
            (corrected - ref).alias(f"{i}_diff"),
        ]
    return matched.select("lot_id", "obs_date", "year", "image_id", *out)


def to_observations(corrected: DataFrame) -> DataFrame:
    """Corrected rows in the columns of the observation table."""
    return corrected.select(*OBSERVATION_COLUMNS)


def difference_summary(corrected: DataFrame, indices: Sequence[str] = INDICES) -> DataFrame:
    """Mean, sample std and mean absolute value of the difference per index."""

    def measures(i: str) -> dict[str, Column]:
        diff = F.col(f"{i}_diff")
        return {"mean": F.avg(diff), "std": F.stddev_samp(diff), "mae": F.avg(F.abs(diff))}

    return by_index(corrected, measures, indices)
