from __future__ import annotations

import numpy as np
import pytest

from lotseries.llm import grid_join

SCHEMA = "vec_id bigint, embedding array<float>, node bigint, component bigint, n_links int, least int, v string"


def usable(v, width):
    return v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v) and any(v)


def plainly(rows, width, cosine=0.95):
    good = [usable(v, width) for _, v in rows]
    m = np.array([v if g else [0.0] * width for g, (_, v) in zip(good, rows)], float)
    norm = np.linalg.norm(m, axis=1)
    norm[norm == 0] = 1
    linked = (m @ m.T) / norm[:, None] / norm[None] >= cosine
    np.fill_diagonal(linked, False)
    label = np.arange(len(rows))
    while True:
        least = np.minimum(label, np.where(linked, label[None], len(rows)).min(axis=1, initial=len(rows)))
        if (least == label).all():
            break
        label = least
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(label == label[k]) if rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((i, int(linked[k].sum()), component, i == component))
    return sorted(out, key=str)


def run(spark, rows, parts=3, schema=SCHEMA):
    full = [(i, v, 7, 8, 9, 1, "x") for i, v in rows]
    found = grid_join.near_vectors(spark.createDataFrame(full, schema).repartition(parts))
    return sorted((tuple(r) for r in found.collect()), key=str)


def table(seed=1, width=10, copies=30, chain=40):
    r = np.random.default_rng(seed)
    f4 = lambda v: [float(x) for x in np.asarray(v, "f4")]
    rows = [(i, f4(r.normal(size=width))) for i in range(300)]
    near = [(400 + i, f4(np.array(rows[i % 20][1]) + r.normal(0, 0.12, width))) for i in range(200)]
    rows += near + [(1000 + i, rows[5][1]) for i in range(copies)]  # copies
    rows += [(1200 + i, f4(np.array(rows[6][1]) * (i + 2))) for i in range(5)]  # of other lengths
    turn = [(2000 + i, f4([np.cos(i * 0.3), np.sin(i * 0.3)] + [0] * (width - 2))) for i in range(chain)]  # a long chain
    rows += turn + [rows[5], (7, rows[8][1]), (None, rows[5][1]), (None, f4(r.normal(size=width) * 9))]
    bad = [None, [], [1.0] * 4, [float("nan")] + [0.1] * (width - 1), [float("inf")] + [0.1] * (width - 1)]
    bad += [[None] + [0.1] * (width - 1), [0.0] * width]
    return rows + [(3000 + i, v) for i, v in enumerate(bad)] + [(None, None)]


def test_equals_brute_force(spark):
    assert run(spark, table()) == plainly(table(), 10)


@pytest.mark.parametrize("rows_a_block,leaf,parts", [(8, 2, 4), (37, 8, 2), (64, 16, 1)])
def test_many_small_blocks(spark, monkeypatch, rows_a_block, leaf, parts):
    monkeypatch.setattr(grid_join, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    monkeypatch.setattr(grid_join, "FAN_BITS", 2)
    rows = table(seed=3)
    assert run(spark, rows, parts) == plainly(rows, 10)


def test_links_within_and_between_blocks(monkeypatch):
    monkeypatch.setattr(grid_join, "LEAF", 16)
    r = np.random.default_rng(7)
    centres = r.normal(size=(12, 6))
    v = centres[r.integers(0, 12, 230)] + r.normal(0, 0.15, (230, 6))
    copies = r.integers(1, 4, 230)
    turn = grid_join.principal(grid_join.unit_vectors(v), 3)
    order = np.lexsort((grid_join.unit_vectors(v) @ turn).T[::-1])
    v, copies = v[order], copies[order]
    block = lambda i, j: grid_join.Block(i, copies[i:j].astype("<i8").tobytes(), v[i:j].tobytes(), "<f8", turn)
    a, b = block(0, 130), block(130, 230)
    u = grid_join.unit_vectors(v)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    got = np.zeros(230, int)
    for pair in ((a, a), (a, b), (b, b)):
        for row in grid_join.Links(*pair, 0.95).rows().to_pylist():
            got[row["node"]] += row["links"]
            assert row["root"] <= row["node"]
    assert (got == linked @ copies).all()


def test_distant_blocks_are_not_compared(monkeypatch):
    taken = []
    monkeypatch.setattr(grid_join.Links, "_leaf", lambda self, s, t: taken.append((s, t)))
    turn = np.eye(4)[:, :2]
    block = lambda v: grid_join.Block(0, np.ones(len(v), "<i8").tobytes(), np.array(v).tobytes(), "<f8", turn)
    east, north = block([[1.0, 0, 0, 0.1]] * 20), block([[0, 1.0, 0.1, 0]] * 20)
    grid_join.Links(east, north, 0.95)
    assert not taken
    grid_join.Links(east, east, 0.95)
    assert len(taken) == 1


def test_threshold_is_met_exactly(spark):
    rows = [(1, [1.0, 0.0]), (2, [3.0, 4.0]), (3, [4.0, 3.0]), (4, [-1.0, 0.0]), (5, [-1e-38, 2e-38]), (6, [-1.5e38, 3e38])]
    full = [(i, v, 7, 8, 9, 1, "x") for i, v in rows]
    found = grid_join.near_vectors(spark.createDataFrame(full, SCHEMA), cosine=0.96)
    # 2 and 3: (12 + 12) / 25 = 0.96; 5 and 6 point the same way.
    assert {r.vec_id: r.n_links for r in found.collect()} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1, 6: 1}


def test_double_vectors_one_and_none(spark):
    doubles = SCHEMA.replace("array<float>", "array<double>")
    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(size=3)]) for i in range(60)]
    assert run(spark, rows, 2, doubles) == plainly(rows, 3)
    assert run(spark, rows[:1]) == [(0, 0, 0, True)]
    assert run(spark, [(1, None)]) == [(1, 0, 1, True)]
    assert run(spark, []) == []
