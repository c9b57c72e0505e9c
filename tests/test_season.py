from datetime import date

from pyspark.sql import functions as F

from lotseries.functions import season as s
from lotseries.operators import master as m


def test_season_starts_in_november(spark):
    days = {
        date(2020, 10, 31): "2019_2020",
        date(2020, 11, 1): "2020_2021",
        date(2020, 12, 31): "2020_2021",
        date(2021, 1, 1): "2020_2021",
        None: None,
    }
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select("d", s.season_label(F.col("d")).alias("s")).collect()
    assert {r.d: r.s for r in rows} == days


def test_keys_propagate_null_and_read_the_report_text(spark):
    df = spark.createDataFrame([("07-1", "Zafra 2019-2020"), (None, "Zafra 2019-2020"), ("07-1", None)], "lot string, season string")
    keys = [r.lot_season for r in m.add_yield_key(df).collect()]
    assert keys == ["07-1_2019_2020", None, None]


def test_harvest_day_accepts_short_days_and_rejects_impossible_ones(spark):
    df = spark.createDataFrame([("31/02/2020",), ("1/2/2020",), ("05/12/2021",), ("",)], "h string")
    assert [r[0] for r in df.select(s.harvest_day(F.col("h"))).collect()] == [
        None,
        date(2020, 2, 1),
        date(2021, 12, 5),
        None,
    ]


def test_master_keeps_every_observation_and_fans_out(spark):
    obs = m.add_season(
        spark.createDataFrame(
            [("a", date(2020, 12, 1)), ("a", date(2021, 12, 1)), (None, date(2020, 12, 1))],
            "lot_id string, obs_date date",
        )
    )
    yields = m.add_yield_key(
        spark.createDataFrame(
            [("a", "Zafra 2020-2021", "01/03/2021", 1.0), ("a", "Zafra 2020-2021", "05/09/2021", 2.0)],
            "lot string, season string, harvest string, tch double",
        )
    )
    rows = m.build_master(obs, yields).collect()
    assert sorted((r.lot_id or "", r.season, r.harvest or "") for r in rows) == [
        ("", "2020_2021", ""),
        ("a", "2020_2021", "01/03/2021"),
        ("a", "2020_2021", "05/09/2021"),
        ("a", "2021_2022", ""),
    ]
    assert "report_season" in rows[0].asDict()


def _seasons(spark):
    """Lot with harvests in 2018/19, 2019/20 and 2021/22; none in 2020/21."""
    rows = [
        ("a", "2018_2019", "10/02/2019", date(2019, 1, 1)),
        ("a", "2019_2020", "20/02/2020", date(2020, 1, 1)),
        ("a", "2019_2020", "20/02/2020", date(2020, 3, 1)),
        ("a", "2020_2021", None, date(2021, 1, 1)),
        ("a", "2021_2022", "15/02/2022", date(2022, 1, 1)),
    ]
    return spark.createDataFrame(rows, "lot_id string, season string, harvest string, obs_date date")


def _ages(df):
    return {r.obs_date: r.crop_age_days for r in df.collect()}


def test_three_season_ages_and_the_season_gap(spark):
    df = _seasons(spark)
    first = _ages(m.age_since_known_harvest(df))
    assert first[date(2019, 1, 1)] is None
    assert first[date(2020, 1, 1)] == (date(2020, 1, 1) - date(2019, 2, 10)).days
    assert first[date(2021, 1, 1)] is None  # its season has no harvest
    assert first[date(2022, 1, 1)] == (date(2022, 1, 1) - date(2020, 2, 20)).days
    second = _ages(m.age_since_previous_season(df))
    assert second[date(2021, 1, 1)] == (date(2021, 1, 1) - date(2020, 2, 20)).days
    assert second[date(2022, 1, 1)] is None  # the season before has no harvest
    third = _ages(m.age_with_ratoon(df))
    assert third[date(2020, 3, 1)] == 10  # after the season's own harvest
    assert third[date(2021, 1, 1)] is None
    assert [tuple(r) for r in m.season_gaps(df).collect()] == [("a", "2021_2022")]
    flagged = m.flag_season_gaps(m.age_since_known_harvest(df)).collect()
    assert {r.obs_date for r in flagged if r.data_gap} == {date(2022, 1, 1)}
    assert all(r.crop_age_days is None for r in flagged if r.data_gap)
    rolled = m.rollback_to_first_age(m.flag_season_gaps(m.age_with_ratoon(df)))
    assert "data_gap" not in rolled.columns and _ages(rolled) == first
