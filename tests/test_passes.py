"""How often queries read their source tables: what several steps need is built once."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry

DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DIR.exists(), reason="test tables are not there")


def scans(spark, plan, name: str, table: str) -> int:
    text = plan(entry.queries()[name](spark, str(DIR)))
    physical = text[text.index("== Physical Plan ==") :]
    return physical.count(f"{table}.parquet]")


def test_a_sample_reads_its_rows_once(spark, plan):
    assert scans(spark, plan, "scatter_sample", "lineitem") == scans(spark, plan, "match_sources", "lineitem")


def test_season_rules_read_rows_and_seasons_once_each(spark, plan):
    assert scans(spark, plan, "season_gap_flags", "lineitem") <= 2
    assert scans(spark, plan, "rollback_age", "lineitem") <= 1  # the seasons are stored


@pytest.mark.parametrize("name", ["valid_cycles", "ml_dataset", "ols_cross_validation", "huber_cross_validation", "residual_histogram"])
def test_shared_rows_are_stored(spark, plan, name):
    assert scans(spark, plan, name, "lineitem") == 0
