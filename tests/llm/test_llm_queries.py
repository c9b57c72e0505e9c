from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lotseries.llm.queries import LLM_ORACLES

DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DIR.exists(), reason="test tables are not there")


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = entry.queries()[name](spark, str(DIR))
    want = con.execute(LLM_ORACLES[name]).to_arrow_table()
    columns = sorted(got.columns)
    assert sorted(want.column_names) == columns

    def rows(table):
        return Counter(zip(*[table.column(c).to_pylist() for c in columns]))

    assert rows(got.toArrow()) == rows(want)


def test_secret_scan_runs_no_python(spark, plan):
    text = plan(entry.queries()["op9_secret_scan"](spark, str(DIR)))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_pipeline_keeps_columns_and_clean_documents(spark):
    from lotseries.sources.stored import stored

    docs = spark.read.parquet(str(DIR / "documents.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, str(DIR)))
        assert after.columns == columns and 0.8 * docs.count() <= after.count() <= docs.count(), name
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(DIR))
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
