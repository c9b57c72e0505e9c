"""Updates of stored tables: untouched partitions keep their files, and an update that breaks off loses nothing."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lotseries.operators.cycles import add_cycles
from lotseries.plans.training import repair_table
from lotseries.sources import merge

SCHEMA = "k int, other string, v int, flag boolean, part string"


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, "x", i * 10, False, "abc"[i % 3]) for i in range(12)] + [(None, "n", 1, True, "a"), (50, "y", 5, False, None)]
    path = str(tmp_path / "table")
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("part").parquet(path)
    return path, rows


def files(path):
    from pathlib import Path

    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def rows_of(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select("k", "other", "v", "flag", "part").collect()), key=str)


def updates(spark, rows):
    return spark.createDataFrame(rows, "k int, v int, flag boolean")


def changed(before, after):
    return {name.split("/")[0] for name in before.keys() ^ after.keys()}


def test_only_partitions_with_a_change_are_rewritten(spark, table):
    path, rows = table
    before = files(path)
    new = updates(spark, [(1, None, True), (4, 40, False), (999, 1, True), (None, 7, True)])
    found = merge.merge_update(spark, path, new, ["k"], ["v", "flag"], ["part"])
    assert [r.part for r in found.collect()] == ["b"]
    after = files(path)
    assert changed(before, after) == {"part=b"}
    assert rows_of(spark, path) == sorted([(1, "x", None, True, "b") if r[0] == 1 else r for r in rows], key=str)
    assert merge.merge_update(spark, path, new, ["k"], ["v", "flag"], ["part"]).count() == 0
    assert files(path) == after


def test_the_partition_of_nulls(spark, table):
    path, rows = table
    found = merge.merge_update(spark, path, updates(spark, [(50, 6, True)]), ["k"], ["v", "flag"], ["part"])
    assert [r.part for r in found.collect()] == [None]
    assert rows_of(spark, path) == sorted([(50, "y", 6, True, None) if r[0] == 50 else r for r in rows], key=str)


@pytest.mark.parametrize("fails", ["_replace", "created"])
def test_an_update_that_breaks_off_is_ended_or_taken_back(spark, table, monkeypatch, fails):
    path, rows = table
    new = updates(spark, [(1, 11, True), (2, 22, True)])
    wanted = {1: (1, "x", 11, True, "b"), 2: (2, "x", 22, True, "c")}
    with monkeypatch.context() as broken:
        if fails == "_replace":
            broken.setattr(merge, "_replace", lambda *_: 1 / 0)
        else:
            broken.setattr(merge, "_mark_ready", lambda *_: 1 / 0)
        with pytest.raises(Exception):
            merge.merge_update(spark, path, new, ["k"], ["v", "flag"], ["part"])
    assert rows_of(spark, path) == sorted(rows, key=str)  # the table is as it was
    if fails == "_replace":
        # worse: one partition has gone already, its new content lies beside the table
        import shutil

        shutil.move(f"{path}/part=b", f"{path}/_gone")
    merge.recover(spark, path, ["part"])
    ended = sorted([wanted.get(r[0], r) for r in rows], key=str)
    assert rows_of(spark, path) == (ended if fails == "_replace" else sorted(rows, key=str))
    merge.merge_update(spark, path, new, ["k"], ["v", "flag"], ["part"])
    assert rows_of(spark, path) == ended


def test_reset_columns(spark, table):
    path, rows = table
    before = files(path)
    merge.reset_columns(spark, path, {"v": F.lit(None), "flag": F.lit(False)}, ["part"], F.col("k") == 3)
    assert changed(before, files(path)) == {"part=a"}
    assert rows_of(spark, path) == sorted([(3, "x", None, False, "a") if r[0] == 3 else r for r in rows], key=str)
    merge.reset_columns(spark, path, {"v": F.lit(0)}, ["part"])
    assert {r[2] for r in rows_of(spark, path)} == {0}


def test_repair_run_twice_leaves_files_alone(spark, tmp_path):
    day = date(2020, 1, 1)
    rows = [(f"l{k}", day + timedelta(days=9 * i + k), 0.5, h) for k in range(4) for i in range(90)
            for h in [f"{1 + k:02d}/06/202{(9 * i) // 365}"]]
    master = spark.createDataFrame(rows, "lot_id string, obs_date date, ndvi_ref double, harvest string")
    good = add_cycles(master).withColumn("year", F.year("obs_date"))
    path = str(tmp_path / "master")
    good.write.partitionBy("year").parquet(path)
    want = sorted(map(str, spark.read.parquet(path).collect()))
    whole = files(path)
    assert repair_table(spark, path, ["year"]).count() == 0 and files(path) == whole
    merge.reset_columns(spark, path, {"crop_age_days": F.lit(-1), "data_gap": F.lit(True)}, ["year"], F.col("year") == 2021)
    spoiled = files(path)
    assert [r.year for r in repair_table(spark, path, ["year"]).collect()] == [2021]
    repaired = files(path)
    assert changed(spoiled, repaired) == changed(whole, repaired) == {"year=2021"}
    assert sorted(map(str, spark.read.parquet(path).collect())) == want
    assert repair_table(spark, path, ["year"]).count() == 0 and files(path) == repaired


def test_only_affected_partitions_are_read(spark, table, monkeypatch, plan):
    path, _ = table
    texts = []
    whole = merge._rewrite

    def seen(spark, path, changed, make, partition_by):
        def looked(rows):
            texts.append(plan(rows))
            return make(rows)

        return whole(spark, path, changed, looked, partition_by)

    monkeypatch.setattr(merge, "_rewrite", seen)
    merge.merge_update(spark, path, updates(spark, [(1, 5, True)]), ["k"], ["v", "flag"], ["part"])
    filters = texts[0].split("PartitionFilters: [")[-1].split("]")[0]
    assert "part" in filters and "(b" in filters or "= b" in filters or "IN (b)" in filters, filters


def test_tables_with_two_levels_of_folders(spark, tmp_path):
    path = str(tmp_path / "two")
    rows = [(i, "x", i, False, p, q) for i, (p, q) in enumerate((p, q) for p in (None, "a", "b") for q in (1, 2, None))]
    schema = SCHEMA + ", sub int"
    spark.createDataFrame(rows, schema).write.partitionBy("part", "sub").parquet(path)
    before = files(path)
    new = updates(spark, [(0, 70, True), (4, 74, True), (8, 78, True), (5, 5, False)])
    found = merge.merge_update(spark, path, new, ["k"], ["v", "flag"], ["part", "sub"])
    assert {(r.part, r["sub"]) for r in found.collect()} == {(None, 1), ("a", 2), ("b", None)}
    got = {tuple(r) for r in spark.read.parquet(path).select("k", "other", "v", "flag", "part", "sub").collect()}
    assert got == {(k, o, 70 + k, True, p, q) if k in (0, 4, 8) else (k, o, v, f, p, q) for k, o, v, f, p, q in rows}
    assert len(before.keys() ^ files(path).keys()) == 6  # three files gone, three new
