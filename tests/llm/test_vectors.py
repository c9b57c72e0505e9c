from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotseries.llm import neighbours, top_k

SCHEMA = "vec_id bigint, embedding array<float>, score double, rank int, part int"


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(0, 0.2, 12).astype("f4")], 0.0, 1, 2) for i in range(600)]
    rows += [(1000 + i, rows[5][1], 0.0, 1, 2) for i in range(60)]  # copies tie
    rows += [rows[5], rows[7]]  # repeated rows
    bad = [None, [], [1.0] * 5, [float("nan")] + [0.1] * 11, [float("inf")] + [0.1] * 11, [None] + [0.1] * 11]
    rows += [(2000 + i, v, 0.0, 1, 2) for i, v in enumerate(bad)]
    rows += [(None, rows[0][1], 0.0, 1, 2), (3000, [0.0] * 12, 0.0, 1, 2)]
    return spark.createDataFrame(rows, SCHEMA)


def usable(table, zero: bool):
    good = {}
    for row in table.collect():
        v = row.embedding
        if row.vec_id is not None and v and len(v) == 12 and all(x is not None and np.isfinite(x) for x in v):
            if zero or any(v):
                good[row.vec_id] = np.array(v, float)
    ids = np.array(sorted(good))
    return ids, np.stack([good[i] for i in ids])


def best(ids, scores, own, k):
    order = [j for j in np.lexsort((ids, -scores)) if ids[j] != own][:k]
    return [(int(ids[j]), scores[j]) for j in order]


def test_top_k_is_exact(spark, table):
    ids, v = usable(table, True)
    whole = np.floor(v * 256).astype(int)
    got = {}
    for r in top_k.exact_top_k(table, F.col("vec_id") % 5 == 0, 7).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == {i for i in ids.tolist() if i % 5 == 0}
    for q, rows in got.items():
        scores = whole @ whole[list(ids).index(q)]
        assert [rows[k + 1] for k in range(7)] == best(ids, scores, q, 7)


def test_top_k_of_few_and_none(spark, table):
    few = table.where("vec_id in (0, 1, 2)")
    rows = top_k.exact_top_k(few, F.col("vec_id") == 0, 5).collect()
    assert [r.rank for r in rows] == [1, 2]
    assert top_k.exact_top_k(table.limit(0), F.col("vec_id") == 0, 5).collect() == []


def test_neighbours_find_nine_tenths_with_exact_scores(spark, table):
    ids, v = usable(table, False)
    found = neighbours.nearest_neighbours(table, F.col("vec_id") % 5 == 0, 10, parts=8)
    hit = total = 0
    for q, rows in found.toPandas().groupby("query_id"):
        scores = np.cumsum(v * v[list(ids).index(q)], axis=1)[:, -1]
        want = best(ids, scores, q, 10)
        hit += len({i for i, _ in want} & set(rows.vec_id))
        total += 10
        known = dict(zip(ids.tolist(), scores))
        order = rows.sort_values("rank")
        assert all(known[i] == s for i, s in zip(order.vec_id, order.score)) and q not in set(order.vec_id)
        assert list(zip(-order.score, order.vec_id)) == sorted(zip(-order.score, order.vec_id))
    assert hit / total >= 0.9


def test_neighbours_of_few_and_none(spark, table):
    few = table.where("vec_id in (0, 1, 2, 3000)")
    rows = neighbours.nearest_neighbours(few, F.col("vec_id") == 0, 20).collect()
    assert sorted(r.vec_id for r in rows) == [1, 2]
    assert neighbours.nearest_neighbours(table.limit(0), F.col("vec_id") == 0, 5).collect() == []


def test_parts_are_balanced():
    r = np.random.default_rng(2)
    v = r.normal(size=(800, 8))
    graph = neighbours._nearest(v, np.arange(800), v, 8)
    sizes = np.bincount(neighbours.balanced_parts(graph, v, 8), minlength=8)
    assert sizes.max() <= 111 and sizes.min() >= 50
