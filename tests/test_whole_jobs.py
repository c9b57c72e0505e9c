"""Queries that once did less than their whole job."""

from __future__ import annotations

import __spark_entry__ as entry


def test_lists_of_pages_keep_all_their_cells(spark, tmp_path):
    items = "".join(f"<li>{i}</li>" for i in range(7))
    page = f"<ul>{items}</ul><ul><li>a</li><li> </li></ul>"
    spark.createDataFrame([(1, page)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = [tuple(r)[1:] for r in entry.queries()["html_table"](spark, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == [("0", "1", "2", "3", "4", "5", "6", None), ("a", *[None] * 7)]
