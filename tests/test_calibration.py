from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from lotseries.operators import calibrate as cal
from lotseries.operators import explore, sampling
from lotseries.operators.matching import clean_ranges, match_sources

MEANS = ["ndvi_mean", "ndwi11_mean", "msi11_mean"]


def test_cleaning_keeps_bounds_and_drops_everything_else(spark):
    inf = float("inf")
    values = [(1.0, -1.0, 0.0), (1.0001, -1.0001, -0.1), (inf, -inf, inf), (float("nan"), None, 10.0), (0.5, 0.5, 10.1)]
    df = spark.createDataFrame(values, ", ".join(f"{c} double" for c in MEANS))
    got = [tuple(r) for r in clean_ranges(df).collect()]
    assert got == [(1.0, -1.0, 0.0), (None,) * 3, (None,) * 3, (None, None, 10.0), (0.5, 0.5, None)]


def test_matching_uses_the_reference_year_and_null_keys_only_if_asked(spark):
    d = date(2021, 1, 1)
    means = ", ".join(f"{c} double" for c in MEANS)
    ref = spark.createDataFrame([("a", d, 2020, 0.1, 0.2, 0.3), (None, d, 2021, 0.1, 0.2, 0.3), ("b", d, 2021, 0.1, 0.2, 0.3)], f"lot_id string, obs_date date, year int, {means}")
    stac = spark.createDataFrame([("a", d, "i", 0.4, 0.5, 0.6), (None, d, "j", 0.4, 0.5, 0.6), ("c", d, "k", 0.4, 0.5, 0.6)], f"lot_id string, obs_date date, image_id string, {means}")
    rows = lambda got: {(r.lot_id, r.year, r.image_id, r.ndvi_ref, r.ndvi_stac) for r in got.collect()}
    assert rows(match_sources(ref, stac)) == {("a", 2020, "i", 0.1, 0.4)}
    assert rows(match_sources(ref, stac, match_nulls=True)) == {("a", 2020, "i", 0.1, 0.4), (None, 2021, "j", 0.1, 0.4)}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    n = 3000
    frame = pd.DataFrame({"lot_id": [f"l{i % 50}" for i in range(n)], "obs_date": [date(2019, 12, 31) + timedelta(days=int(i)) for i in rng.integers(1, 2190, n)], "image_id": "i"})
    frame["year"] = [2020 + i % 6 for i in range(n)]
    for k, (i, a, b) in enumerate((("ndvi", 0.83, 0.007), ("ndwi11", 0.9, 0.1), ("msi11", 0.75, 0.06))):
        x = rng.uniform(-0.9, 0.9, n) + k
        noise = rng.normal(0, 0.03, n) + (rng.random(n) < 0.05) * rng.uniform(0.5, 3, n)
        frame[f"{i}_stac"] = np.where(rng.random(n) < 0.03, np.nan, x)
        frame[f"{i}_ref"] = np.where(rng.random(n) < 0.03, np.nan, a * x + b + noise)
    return frame


@pytest.fixture(scope="module")
def matched(spark, data):
    return spark.createDataFrame(data.astype(object).where(data.notna(), None), "lot_id string, obs_date date, image_id string, year int, ndvi_stac double, ndvi_ref double, ndwi11_stac double, ndwi11_ref double, msi11_stac double, msi11_ref double").cache()


def pairs(data, i, rows=None):
    sub = data if rows is None else data[rows]
    sub = sub[[f"{i}_stac", f"{i}_ref"]].dropna()
    return sub.iloc[:, 0].to_numpy(), sub.iloc[:, 1].to_numpy()


def scores(x, y, a, b):
    r = y - (a * x + b)
    return 1 - (r @ r) / ((y - y.mean()) @ (y - y.mean())), np.abs(r).mean()


def test_least_squares_fits_and_scores(matched, data):
    final = {r["index"]: r for r in cal.fit_final(matched).collect()}
    for i in ("ndvi", "ndwi11", "msi11"):
        assert np.allclose((final[i].slope, final[i].intercept), np.polyfit(*pairs(data, i), 1))
    folds = cal.cross_validate(matched)
    rows = folds.collect()
    assert len(rows) == 18
    for r in rows:
        a, b = np.polyfit(*pairs(data, r["index"], data.year != r.year), 1)
        x, y = pairs(data, r["index"], data.year == r.year)
        assert np.allclose((r.slope, r.intercept, r.n, r.r2, r.mae), (a, b, len(x), *scores(x, y, a, b)))
    for s in cal.summarize_folds(folds).collect():
        r2 = [r.r2 for r in rows if r["index"] == s["index"]]
        assert np.allclose((s.r2_mean, s.r2_std), (np.mean(r2), np.std(r2)))
    for r in cal.fit_holdout(matched, 2025).collect():
        a, b = np.polyfit(*pairs(data, r["index"], data.year != 2025), 1)
        train, test = pairs(data, r["index"], data.year != 2025), pairs(data, r["index"], data.year == 2025)
        want = (a, b, len(train[0]), *scores(*train, a, b), len(test[0]), *scores(*test, a, b))
        assert np.allclose(tuple(r)[1:], want)


def huber_by_weights(x, y):
    """Plain reweighting of the same objective, run until it stands still."""
    a, b = np.polyfit(x, y, 1)
    s = np.std(y - a * x - b)
    for _ in range(500):
        r = np.abs(y - a * x - b)
        w = np.minimum(1, 1.35 * s / np.maximum(r, 1e-12))
        m = np.array([[w @ (x * x) + 1e-4 * s, w @ x], [w @ x, w.sum()]])
        a, b = np.linalg.solve(m, [w @ (x * y), w @ y])
        far = r > 1.35 * s
        s = np.sqrt((r[~far] ** 2).sum() / (len(x) - 1.35**2 * far.sum()))
    return a, b


def test_robust_fits_and_scores(matched, data):
    final = cal.fit_final_huber(matched, "msi11").first()
    assert np.allclose((final.slope, final.intercept), huber_by_weights(*pairs(data, "msi11")), atol=1e-7)
    assert abs(final.slope - 0.75) < 0.01  # the outliers do not pull the line
    rows = cal.cross_validate_huber(matched, "msi11", list(range(2020, 2026))).collect()
    assert len(rows) == 6
    for r in rows:
        a, b = huber_by_weights(*pairs(data, "msi11", data.year != r.year))
        x, y = pairs(data, "msi11", data.year == r.year)
        assert np.allclose((r.slope, r.intercept, r.n, r.r2, r.mae), (a, b, len(x), *scores(x, y, a, b)), atol=1e-6)
    h = cal.fit_holdout_huber(matched, "msi11", 2025).first()
    assert h.train_n + h.test_n == len(pairs(data, "msi11")[0])


def test_robust_fits_of_nothing_are_null(matched):
    none = matched.where("year is null")
    assert cal.fit_final_huber(none, "msi11").first()[1:] == (None, None)
    rows = {r.year: r.slope for r in cal.cross_validate_huber(matched, "msi11", [2020, 2021, 2090]).collect()}
    assert rows[2020] is not None and 2090 not in rows


def test_rows_without_a_year_count_in_the_final_fit(spark):
    rows = [("l", date(2020, 1, 1), "i", y, float(k), v * k) for k, (y, v) in enumerate([(2020, 1.5)] * 3 + [(None, 9.0)] * 3)]
    df = spark.createDataFrame(rows, "lot_id string, obs_date date, image_id string, year int, ndvi_stac double, ndvi_ref double")
    x, y = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    assert np.isclose(cal.fit_final(df, ["ndvi"]).first().slope, np.polyfit(x, y, 1)[0])


def test_an_exact_line_is_found(spark):
    rows = [("l", date(2020, 1, 1), "i", 2020 + k % 3, k / 10, 0.8 * k / 10 + 0.1) for k in range(30)]
    df = spark.createDataFrame(rows, "lot_id string, obs_date date, image_id string, year int, ndvi_stac double, ndvi_ref double")
    for r in cal.cross_validate(df, ["ndvi"]).collect():
        assert np.allclose((r.slope, r.intercept, r.r2, r.mae), (0.8, 0.1, 1.0, 0.0), atol=1e-9)


def test_exploration_equals_pandas(matched, data):
    for r in explore.source_summary(matched).collect():
        x, y = data[f"{r['index']}_stac"], data[f"{r['index']}_ref"]
        want = (x.mean(), x.std(), y.mean(), y.std(), (x - y).mean(), (x - y).std(), x.corr(y))
        assert np.allclose(tuple(r)[1:], want)
    for r in explore.bias_by_year(matched).collect():
        d = (data[f"{r['index']}_stac"] - data[f"{r['index']}_ref"])[data.year == r.year]
        assert np.allclose((r.bias_mean, r.bias_std), (d.mean(), d.std()))
    counts = explore.matched_counts(matched).first()
    assert tuple(counts) == (len(data), 50, data.obs_date.nunique(), list(range(2020, 2026)))
    found = explore.residual_histogram(matched).collect()
    for index in ("ndvi", "ndwi11", "msi11"):
        want, _ = np.histogram((data[f"{index}_stac"] - data[f"{index}_ref"]).dropna(), bins=100)
        got = {r.bin: r["rows"] for r in found if r["index"] == index}
        assert [got.get(i, 0) for i in range(100)] == want.tolist()
    for r in explore.identity_range(matched).collect():
        both = data[[f"{r['index']}_stac", f"{r['index']}_ref"]]
        assert (r.low, r.high) == (both.min().min(), both.max().max())


def test_correction_uses_the_validation_factors(matched, data):
    out = cal.apply_correction(matched).toPandas()
    line = cal.VALIDATION_FACTORS["ndvi"]
    want = data.ndvi_stac * line["slope"] + line["intercept"]
    assert np.allclose(sorted(out.ndvi_corrected.dropna()), sorted(want.dropna()))
    s = {r["index"]: r for r in cal.difference_summary(cal.apply_correction(matched)).collect()}
    d = (want - data.ndvi_ref).dropna()
    assert np.allclose((s["ndvi"]["mean"], s["ndvi"]["std"], s["ndvi"]["mae"]), (d.mean(), d.std(), d.abs().mean()))


def test_samples_are_repeatable_whatever_the_partitioning(matched):
    one = sampling.sample_rows(matched, 100, 42).toPandas()
    two = sampling.sample_rows(matched.repartition(7), 100, 42).toPandas()
    other = sampling.sample_rows(matched, 100, 43).toPandas()
    key = ["lot_id", "obs_date", "ndvi_stac", "msi11_ref"]
    assert len(one) == 100
    assert sorted(map(str, one[key].values.tolist())) == sorted(map(str, two[key].values.tolist()))
    assert sorted(map(str, one[key].values.tolist())) != sorted(map(str, other[key].values.tolist()))


def test_a_group_sample_fails_if_there_are_too_few(spark):
    groups = spark.range(10).selectExpr("cast(id as string) lot_id")
    assert sampling.sample_groups(groups, 10).count() == 10
    with pytest.raises(Exception, match="cannot take 11 groups out of 10"):
        sampling.sample_groups(groups, 11).collect()


def test_the_calibration_job(matched):
    from lotseries.plans.calibration import calibrate_sources

    job = calibrate_sources(matched, list(range(2020, 2026)), 2025)
    assert job.final.count() == 3 and job.holdout.count() == 3 and job.folds.count() == 18


def test_the_whole_job_writes_factors_and_observations(spark, matched, tmp_path):
    from lotseries.plans import calibration
    from lotseries.sources import readers

    def source(kind):
        means = [matched[f"{i}_{kind}"].alias(f"{i}_mean") for i in ("ndvi", "ndwi11", "msi11")]
        return matched.select("lot_id", "obs_date", "image_id", "year", *means).dropDuplicates(["lot_id", "obs_date"])

    paths = str(tmp_path / "factors"), str(tmp_path / "observations")
    fits = calibration.run(source("ref"), source("stac"), list(range(2020, 2026)), *paths)
    used = readers.factor_dict(readers.read_factors(spark, paths[0]))
    assert used == readers.factor_dict(fits.holdout.select("index", "slope", "intercept"))
    obs = readers.read_observations_csv(spark, paths[1])
    row = obs.where("ndvi_corrected is not null").first()
    assert obs.count() == source("ref").count() and -2 < row.ndvi_corrected < 3


def test_one_pass_over_the_rows_without_collecting_groups(matched, plan):
    text = plan(explore.source_summary(matched))
    assert text[text.index("== Physical Plan ==") :].count("Exchange") == 1
