from __future__ import annotations

import json
from datetime import date

import pytest

from lotseries.operators.calibrate import VALIDATION_FACTORS
from lotseries.schema import INDICES, OBSERVATION_COLUMNS, YIELD_COLUMNS
from lotseries.sources import readers, writers
from lotseries.sources.stored import stored

OLD = "lote string, fecha string, imagen_id string, ndvi_promedio double, ndvi_max double, ndwi11_promedio double, msi11_promedio double"


# Published coefficients of the fit on all years.
FINAL_FACTORS = {
    "ndvi": {"slope": 0.8335061263110403, "intercept": 0.005057379141489571},
    "ndwi11": {"slope": 0.8924874302218037, "intercept": 0.10275590626693369},
    "msi11": {"slope": 0.7452828125819251, "intercept": 0.061452947183635094},
}


def test_reference_year_is_the_folder_and_scene_year_the_date(spark, tmp_path, plan):
    for folder, lot in (("2020", "a"), ("2021", "b"), ("notes", "c")):
        df = spark.createDataFrame([(lot, "2021-01-05", "i", 0.1, 0.9, 0.2, 0.3)], OLD)
        df.coalesce(1).write.parquet(str(tmp_path / "in" / folder))
    ref = readers.read_reference(spark, str(tmp_path / "in"), [2020, 2021])
    assert {(r.lot_id, r.year, r.obs_date) for r in ref.collect()} == {("a", 2020, date(2021, 1, 5)), ("b", 2021, date(2021, 1, 5))}
    text = plan(ref)
    assert "ndvi_max" not in text[text.index("== Physical Plan ==") :].split("ReadSchema")[1]
    assert readers.read_reference(spark, str(tmp_path / "in")).count() == 3
    scenes = readers.read_scene_indices(spark, str(tmp_path / "in"))
    assert {(r.lot_id, r.year, r.image_id) for r in scenes.collect()} == {(k, 2021, "i") for k in "abc"}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    df = spark.createDataFrame(
        [("2020", "2021-01-05", "a", 0.1, 0.2, 0.3, 0.4, 0.5, None, "i", 9.0)],
        "year string, fecha string, cod_cg string, ndvi_corrected double, ndvi_ref double, ndwi11_corrected double, "
        "ndwi11_ref double, msi11_corrected double, msi11_ref double, id_img string, ndvi_diff double",
    )
    writers.write_csv(df, str(tmp_path / "csv"))
    got = readers.read_observations_csv(spark, str(tmp_path / "csv"))
    assert got.columns == OBSERVATION_COLUMNS
    assert tuple(got.first()) == ("a", date(2021, 1, 5), "i", 0.1, 0.2, 0.3, 0.4, 0.5, None)


def test_a_rerun_replaces_only_its_year(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = "lot_id string, obs_date string, ndvi_mean double"
    writers.write_indices(spark.createDataFrame([("a", "2020-05-01", 0.1), ("a", "2021-05-01", 0.2)], schema), path)
    writers.write_indices(spark.createDataFrame([("b", "2021-06-01", 0.3)], schema), path)
    assert {(r.lot_id, r.year) for r in spark.read.parquet(path).collect()} == {("a", 2020), ("b", 2021)}


def test_tables_are_replaced(spark):
    writers.write_table(spark.range(5), "numbers")
    writers.write_table(spark.range(3), "numbers")
    assert spark.table("numbers").count() == 3
    spark.sql("DROP TABLE numbers")


def test_factors_round_trip(spark, tmp_path):
    def rows(factors):
        return spark.createDataFrame([(i, v["slope"], v["intercept"]) for i, v in factors.items()], "index string, slope double, intercept double")

    writers.write_factors(rows(FINAL_FACTORS), rows(VALIDATION_FACTORS), str(tmp_path / "f"))
    for name, factors in (("validation_1", VALIDATION_FACTORS), ("final", FINAL_FACTORS)):
        assert readers.factor_dict(readers.read_factors(spark, str(tmp_path / "f"), name)) == factors
    pretty = tmp_path / "hand.json"
    pretty.write_text(json.dumps({"final": FINAL_FACTORS, "validation_1": VALIDATION_FACTORS}, indent=2))
    assert readers.factor_dict(readers.read_factors(spark, str(pretty))) == VALIDATION_FACTORS


def test_lots_fall_back_to_the_polygon_id_only_without_the_column(spark, tmp_path):
    ring = "array(named_struct('x', 0d, 'y', 0d)) AS ring"
    spark.sql(f"SELECT 7L AS polygon_id, {ring}").write.parquet(str(tmp_path / "a"))
    spark.sql(f"SELECT 7L AS polygon_id, CAST(NULL AS STRING) AS cod, {ring}").write.parquet(str(tmp_path / "b"))
    assert readers.read_lots(spark, str(tmp_path / "a")).first().lot_id == "7"
    assert readers.read_lots(spark, str(tmp_path / "b"), "cod").first().lot_id is None


def test_manifest_lists_nested_files(spark, tmp_path):
    for name in ("a/x_20210101.tif", "a/b/y.tif", "z.shp"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("data")
    got = readers.read_manifest(spark, str(tmp_path), ".tif").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in got) == ["x_20210101.tif", "y.tif"] and got[0].length == 4


def test_pixels_prune_to_the_scene(spark, tmp_path, plan):
    df = spark.createDataFrame([("s1", "nir", 0, 0, 1.0), ("s2", "nir", 0, 0, 2.0)], "scene_id string, band string, row int, col int, value double")
    df.write.partitionBy("scene_id").parquet(str(tmp_path / "p"))
    one = readers.read_pixels(spark, str(tmp_path / "p")).where("scene_id = 's2' AND band = 'nir'")
    assert one.first().value == 2.0
    text = plan(one)
    assert "PartitionFilters: [isnotnull(scene_id" in text and "EqualTo(band,nir)" in text


def test_query_parameters(spark):
    spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "lot string, n int").createOrReplaceTempView("lots_view")
    sql = "SELECT lot FROM lots_view WHERE array_contains(:lots, lot) AND n >= :low ORDER BY lot"
    assert [r.lot for r in readers.read_query(spark, sql, lots=["a", "b"], low=2).collect()] == ["b"]


def test_stored_results_live_in_the_shared_folder(spark):
    df = stored(spark.range(10).withColumnRenamed("id", "n"))
    assert df.count() == 10 and df.inputFiles()[0].startswith("file://" + spark.conf.get("spark.checkpoint.dir"))


def test_fixed_lists():
    assert len(YIELD_COLUMNS) == len(set(YIELD_COLUMNS)) and {"tch", "cierre", "lote"} <= set(YIELD_COLUMNS)
    assert INDICES == ["ndvi", "ndwi11", "msi11"]


def test_training_tables(spark):
    from lotseries.plans.training import build_tables, training_rows

    obs = spark.createDataFrame([("a", date(2020, 1, 1 + k), 0.5) for k in range(9)] + [("a", date(2020, 9, 1), 0.5), ("a", date(2019, 1, 1), 0.5)], "lot_id string, obs_date date, ndvi_ref double")
    yields = spark.createDataFrame([("a", "Zafra 2018-2019", "01/10/2019", 80.0), ("a", "Zafra 2019-2020", "01/10/2020", 90.0)], "lot string, season string, harvest string, tch double")
    build_tables(spark, obs, yields, "master_t", "dataset_t")
    assert spark.table("dataset_t").count() == 10 == training_rows(obs, yields).count()
    assert {r.tch for r in spark.table("dataset_t").collect()} == {90.0}
    for name in ("master_t_joined", "master_t", "dataset_t"):
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("column", ["ndvi_ref", "harvest"])
def test_only_narrow_columns_reach_the_day_table(spark, tmp_path, plan, column):
    from lotseries.operators.cycles import lot_days

    spark.sql("SELECT 'a' AS lot_id, DATE'2020-01-01' AS obs_date, 0.1D AS ndvi_ref, '01/02/2020' AS harvest, 'wide' AS notes").write.parquet(str(tmp_path / "m"))
    text = plan(lot_days(spark.read.parquet(str(tmp_path / "m"))))
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert column in schema and "notes" not in schema


def test_stored_tables_go_when_they_are_released(spark, tmp_path):
    from lotseries.sources.stored import WORK_DIR, drop_stored, release

    spark.conf.set(WORK_DIR, str(tmp_path))
    try:
        first, second = (stored(spark.range(10).withColumnRenamed("id", "n")) for _ in range(2))
        release(first)
        assert second.count() == 10 and len(list((tmp_path / "lotseries").iterdir())) == 1
        drop_stored(spark)
        assert not list((tmp_path / "lotseries").iterdir())
    finally:
        spark.conf.unset(WORK_DIR)


def test_stored_works_in_a_session_without_any_setting(tmp_path):
    import os
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "from lotseries.sources.stored import stored, drop_stored\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert stored(s.range(3)).count() == 3\n"
        "drop_stored(s)\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.getcwd()}
    subprocess.run([sys.executable, "-c", code], env=env, check=True, timeout=120)
