"""Hot keys: the plans must split them and the results must stay whole."""

from __future__ import annotations

import contextlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from lotseries.operators import cycles, raster
from lotseries.operators.master import age_with_ratoon, build_master, flag_season_gaps
from lotseries.session import SETTINGS, prepare


@pytest.fixture
def small_splits(spark):
    """Thresholds at which the test data counts as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        with contextlib.suppress(Exception):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df) -> str:
    """Final adaptive plan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_rows(spark):
    """A third of the rows belong to one lot and day; the rest to many lots."""
    base = spark.range(0, 60000, 1, 8)
    hot = F.col("id") % 3 == 0
    return base.select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 4000).cast("string"))).alias("lot_id"),
        F.when(hot, F.lit("2021-01-05").cast("date")).otherwise(F.date_add(F.lit("2020-12-01").cast("date"), (F.col("id") % 300).cast("int"))).alias("obs_date"),
        ((F.col("id") % 100) / 100).alias("ndvi_ref"),
        F.md5(F.col("id").cast("string")).alias("image_id"),
        F.lit("2020_2021").alias("season"),
        F.when(hot, "01/06/2021").alias("harvest"),
    ).withColumn("lot_season", F.concat_ws("_", "lot_id", "season"))


def test_the_way_back_to_the_rows_splits_a_hot_day(spark, hot_rows, small_splits):
    out = cycles.add_cycles(hot_rows)
    assert "skew=true" in executed(out)
    assert out.count() == 60000
    hot = out.where("lot_id = 'hot'").agg(F.count("*"), F.min("cycle_end"), F.max("cycle_end")).first()
    assert tuple(hot) == (20000, date(2021, 6, 1), date(2021, 6, 1))


def test_the_yield_join_splits_a_hot_season(spark, hot_rows, small_splits):
    lots = hot_rows.select("lot_id").distinct().withColumn("tch", F.lit(1.0))
    yields = lots.select(F.concat("lot_id", F.lit("_2020_2021")).alias("lot_season"), "tch")
    out = build_master(hot_rows.drop("harvest"), yields, season="none")
    assert "skew=true" in executed(out)
    assert out.where("tch = 1").count() == 60000


def test_season_rules_split_a_hot_season_in_both_joins(spark, hot_rows, small_splits):
    early = spark.sql(
        "SELECT 'hot' lot_id, DATE'2018-01-05' obs_date, 0.5D ndvi_ref, 'x' image_id, '2017_2018' season, "
        "'01/06/2018' harvest, 'hot_2017_2018' lot_season"
    )
    out = flag_season_gaps(age_with_ratoon(hot_rows.unionByName(early)))
    assert executed(out).count("skew=true") >= 2
    assert out.count() == 60001 and out.where("data_gap").count() == 20000


def test_settings_apply(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    prepare(spark)
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_only_one_row_per_lot_and_day_reaches_the_windows(spark, hot_rows):
    assert cycles.lot_days(hot_rows).where("lot_id = 'hot'").count() == 2  # the day and its harvest
    assert cycles.lot_days(hot_rows).where("lot_id = 'hot' and row_count = 20000").count() == 1


def test_a_huge_polygon_unfolds_in_many_tasks(spark):
    ring = "array(" + ", ".join(f"named_struct('x', {x}d, 'y', {y}d)" for x, y in ((0.1, 0.1), (999.9, 0.1), (999.9, 999.9), (0.1, 999.9))) + ")"
    t = ", ".join(f"{v}d AS {n}" for n, v in zip("abcdef", (1, 0, 0, 0, 1, 0)))
    polygon = spark.sql(f"SELECT 's' AS scene_id, 1L AS polygon_id, {ring} AS ring, {t}")
    mask = raster.polygon_mask(polygon)
    per_task = mask.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 1_000_000
    assert len(per_task) >= 3 and max(r["count"] for r in per_task) < 700_000
