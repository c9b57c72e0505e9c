"""Tables stored in buckets: what follows needs no shuffle, and the rows stay whole."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotseries.bindings import queries, tables
from lotseries.operators import cycles
from lotseries.operators.master import add_season, add_yield_key, build_master, build_master_by_lot
from lotseries.sources import writers
from lotseries.sources.stored import drop_stored, in_buckets, stored


@pytest.fixture
def no_broadcasts(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def master(spark):
    """Lots with harvests, a long gap, low values, rows that come twice, and rows without a lot, a day or an NDVI."""
    day = F.date_add(F.lit("2018-01-05").cast("date"), ((F.col("id") * 13) % 1500).cast("int"))
    harvest = F.when(F.col("id") % 4 == 0, F.lit("01/06/2019")).when(F.col("id") % 4 == 1, F.lit("20/05/2021"))
    rows = spark.range(900).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("l"), (F.col("id") % 7).cast("string"))).alias("lot_id"),
        F.when(F.col("id") % 41 != 0, day).alias("obs_date"),
        F.when(F.col("id") % 7 < 4, harvest).alias("harvest"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 90) / 100).alias("ndvi_ref"),
    )
    return rows.union(rows.where("ndvi_ref > 0.5"))


def content(df):
    return sorted(map(str, df.collect()))


def test_the_way_back_by_lot_gives_the_rows_of_the_way_back_by_day(spark, master):
    rows = stored(in_buckets(master, "lot_id"))
    assert content(rows) == content(master)
    found, wanted = cycles.add_cycles(rows, by_lot=True), cycles.add_cycles(master)
    assert found.columns == wanted.columns and content(found) == content(wanted)
    assert found.where("valid_cycle").count() and found.where("data_gap").count() and found.where("lot_id is null").count()
    spoiled = stored(in_buckets(found, "lot_id")).withColumn("crop_age_days", F.lit(None).cast("int"))
    assert content(cycles.recompute_cycles(spoiled, by_lot=True)) == content(cycles.recompute_cycles(spoiled))


def test_yields_by_lot_are_those_by_season(spark):
    days = "('a', DATE'2019-12-05'), ('a', DATE'2019-12-05'), ('a', DATE'2021-12-05'), ('b', DATE'2020-01-05'), (null, DATE'2020-01-05'), ('c', null)"
    observations = add_season(spark.sql(f"SELECT * FROM VALUES {days} AS t(lot_id, obs_date)"))
    reports = "('a', 'Zafra 2019-2020', 'x'), ('a', 'Zafra 2019-2020', 'x'), ('a', 'Zafra 2019-2020', null), ('a', null, 'n'), (null, 'Zafra 2019-2020', 'm'), ('d', 'Zafra 2019-2020', 'o')"
    yields = add_yield_key(spark.sql(f"SELECT * FROM VALUES {reports} AS t(lot, season, harvest)"))
    found, wanted = build_master_by_lot(observations, yields), build_master(observations, yields)
    assert found.dtypes == wanted.dtypes and content(found) == content(wanted)
    assert found.count() == 6 + 4


def test_cycles_of_a_table_in_buckets_need_no_shuffle(spark, master, plan, no_broadcasts):
    rows = stored(in_buckets(master, "lot_id"))
    made = cycles.add_cycles(rows, by_lot=True)
    assert "Exchange" not in plan(made).split("== Physical Plan ==")[1]
    assert all(not f.metadata for f in rows.schema)
    assert "Exchange" in plan(cycles.add_cycles(rows)).split("== Physical Plan ==")[1]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not there")
def test_queries_shuffle_nothing_after_their_stored_table(spark, plan, no_broadcasts):
    for name in ("next_harvest", "cycle_age", "valid_cycles", "repaired_cycles", "match_sources"):
        text = plan(queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "Exchange" not in text.split("== Physical Plan ==")[1], name
    assert "nir" in tables.lot_bands(tables.shipments(spark, "/root/testdata/sf0.001")).columns


def test_a_dropped_table_leaves_the_catalogue(spark, master):
    rows = stored(in_buckets(master, "lot_id", "obs_date"))
    assert rows.count() == master.count()
    drop_stored(spark)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lotseries_")]


def test_csv_files_are_compressed(spark, tmp_path):
    writers.write_csv(spark.range(1000).withColumn("x", F.col("id") / 7), str(tmp_path / "csv"))
    files = [f.name for f in (tmp_path / "csv").iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 1000
