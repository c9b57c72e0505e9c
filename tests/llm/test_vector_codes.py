from __future__ import annotations

import numpy as np
import pytest

from lotseries.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, v array<int>, error bigint, part int"


def row(i, v, label):
    return (i, v, label, "c", [1], -1, 3)


def plainly(rows, parts=8, entries=16, rounds=6):
    """The rounds of the codebooks in Python's integers, every entry looked at."""
    good = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    sizes = [len(r[1]) for r in good]
    width = min(set(sizes), key=lambda w: (-sizes.count(w), w)) if sizes else 0
    good = [(r[0], [int(np.floor(4096 * x)) for x in r[1]], r[2]) for r in good if len(r[1]) == width]
    good.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    cuts = [(int(p[0]), int(p[-1]) + 1) if len(p) else (0, 0) for p in np.array_split(np.arange(width), parts)]
    books = [[v[a:b] for _, v, _ in good[:entries]] for a, b in cuts]

    def nearest(x, book):
        return min((sum((s - t) ** 2 for s, t in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            own = [[] for _ in books[p]]
            for _, v, _ in good:
                own[nearest(v[a:b], books[p])[1]].append(v[a:b])
            books[p] = [[sum(c) // len(o) for c in zip(*o)] if o else e for o, e in zip(own, books[p])]
    out, by_label = [], {}
    for i, v, label in good:
        found = [nearest(v[a:b], book) for (a, b), book in zip(cuts, books)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), error))
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((*r, by_label[r[1]]) for r in out), key=str), text


def run(spark, rows, **how):
    vectors = vector_codes.integer_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    books = vector_codes.train(vectors, **how)
    found = vector_codes.label_errors(vector_codes.encode(vectors, books)).collect()
    return sorted((tuple(r) for r in found), key=str), vector_codes.numbers(books)


def vectors_of(n, width, scale, seed=5):
    r = np.random.default_rng(seed)
    rows = [row(i, r.normal(0, scale, width).tolist(), i % 4 if i % 7 else None) for i in range(n)]
    rows += [row(500 + i, rows[i % 9][1], 1) for i in range(40)]  # copies tie
    rows += [rows[3], row(4, rows[8][1], 2), row(None, rows[2][1], 0)]
    bad = [None, [], [0.5], [float("nan")] + [0.1] * (width - 1), [float("-inf")] + [0.1] * (width - 1)]
    bad += [[None] + [0.1] * (width - 1)]
    return rows + [row(900 + i, v, 1) for i, v in enumerate(bad)]


@pytest.mark.parametrize("width,scale", [(16, 0.2), (19, 0.001), (5, 3.0)])
def test_equals_brute_force(spark, width, scale):
    rows = vectors_of(150, width, scale)
    assert run(spark, rows) == plainly(rows)


def test_large_components_are_exact(spark):
    r = np.random.default_rng(2)
    rows = [row(i, r.normal(0, 3e4, 64).tolist(), i) for i in range(24)]
    values = np.array([[int(np.floor(4096 * x)) for x in v[1]] for v in rows])
    assert vector_codes._kind(values[:, :8]) is object
    assert run(spark, rows) == plainly(rows)


def test_other_parameters_and_few_rows(spark):
    rows = vectors_of(100, 12, 0.3)
    assert run(spark, rows, parts=3, entries=5, rounds=2) == plainly(rows, 3, 5, 2)
    assert run(spark, rows[:3]) == plainly(rows[:3])


def test_ties_go_to_the_smaller_entry():
    book = vector_codes.Codebook(np.array([[0, 0], [4, 0], [4, 0], [2, 0], [-4, 0]]))
    index, distance = book.nearest(np.array([[2, 0], [1, 0], [4, 0], [3, 0], [-2, 0]]))
    assert index.tolist() == [3, 0, 1, 1, 0] and distance.tolist() == [0, 1, 0, 1, 4]


def test_search_looks_at_fewer_entries_than_there_are(monkeypatch):
    r = np.random.default_rng(1)
    entries = r.integers(-4000, 4000, (64, 4))
    values = entries[r.integers(0, 64, 3000)] + r.integers(-200, 200, (3000, 4))
    asked = []
    plain = vector_codes.Codebook._distance
    monkeypatch.setattr(vector_codes.Codebook, "_distance", lambda s, v, e: asked.append(len(v)) or plain(s, v, e))
    index, _ = vector_codes.Codebook(entries).nearest(values)
    want = ((values[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (index == want).all() and sum(asked) < 0.6 * 64 * 3000


def test_too_large_a_component_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [row(1, [1e300] * 8, 0)])


def test_nothing_left(spark):
    assert run(spark, [row(1, None, 0)]) == ([], "")
