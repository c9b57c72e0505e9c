"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lotseries.bindings.oracles import ORACLES
from lotseries.bindings.queries import QUERIES

DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value.isoformat()[:10] if hasattr(value, "isoformat") else value


def content(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    kinds = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    return names, kinds, Counter(tuple(map(plain, row)) for row in zip(*columns))


@pytest.mark.skipif(not DIR.exists(), reason="test tables are not there")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(DIR))
    text = df._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan ==") :]
    assert "CartesianProduct" not in physical and "NestedLoopJoin" not in physical
    assert ("EvalPython" in physical) == (name == "slug_columns")
    got = content(df.toArrow())
    want = content(duck.execute(entry.oracle_sql()[name]).to_arrow_table())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[2] == want[2] and sum(got[2].values()) > 0


def test_own_queries_have_sql():
    assert QUERIES.keys() == ORACLES.keys()
