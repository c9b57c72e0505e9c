"""Sizes and values at the far end: what must stay exact, whole and near linear."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest
from edge import documents, prose
from pyspark.sql import functions as F

from lotseries.llm import personal_data, secret_scan, similar, top_k, toxicity

# -- personal data


def naive(text):
    """The rules tried at every place from the left, one after the other."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        at, rule = 0, re.compile(pattern)
        while at < len(text):
            m = rule.match(text, at)
            if m is None:
                at += 1
                continue
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": kind == "ip" and all(sum(int(c) * 10**k for k, c in enumerate(reversed(p[-400:]))) <= 255 and not p[:-400].strip("0") for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, *m.span()))
            at = m.end()
    return out


def test_rules_equal_a_search_from_every_place():
    r = random.Random(6)
    parts = ["4041894974608795", "4111 1111 1111 1111", "4111-1111-1111-1112", "255.1.02.3", "256.1.1.1", "1.2.3.4.5", "+1 (988) 555-2485",
             "+12", "a.b%c@x-y.co", "@", "a@b", ".a@b.c.d", "é", " ", "  ", "-", ".", "+", "0", "12 345", "x"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert personal_data.base_spans(text) == naive(text), text
    long = "0" * 5000 + "1.2.3.4 " + "0" * 9000 + "256.1.1.1"
    assert [s for s in personal_data.base_spans(long) if s[0] == "ip"] == naive(long)[:1] == [("ip", 0, 5007)]


def test_written_out_addresses_count_as_right():
    text = "write ann.lee (at) mail (dot) example (dot) com or b [at] c.org, at noon dot com"
    places = [(text.index(x), text.index(x) + len(x)) for x in ("ann.lee (at) mail (dot) example (dot) com", "b [at] c.org")]
    assert personal_data.right_spans(text) == {("email", *place) for place in places}


def test_thresholds_come_from_counts_of_any_size():
    bins = {b: (98 if b > 10 else 0, 98 if b > 10 else 50) for b in range(-20, 40)}
    found = personal_data.thresholds({"ip": bins, "card": {3: (0, 9)}, "phone": {-4: (9, 9)}, "email": {7: (1, 1)}})
    assert found == {"ip": 11 / personal_data.BINS_A_UNIT, "email": 7 / personal_data.BINS_A_UNIT}


def test_many_spans_in_one_text(spark):
    r = random.Random(8)
    number = lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
    rows = [(k, f"words {k} call {number()} or id {r.randint(10**9, 10**14)} at 10.{k % 256}.3.4") for k in range(300)]
    selector = personal_data.train(documents(spark, rows))
    assert selector.trees is not None
    times = []
    for n in (2_000, 20_000):
        text = " and ".join(number() if k % 2 else str(r.randint(10**7, 10**12)) for k in range(n))
        start = time.perf_counter()
        base = personal_data.base_spans(text)
        added = selector.added(text, base)
        times.append(time.perf_counter() - start)
        spans = sorted((a, b) for _, a, b in added + base)
        assert len(base) >= n // 2 and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert times[1] < 25 * times[0] + 1


# -- secrets


def test_a_very_long_candidate_and_very_many_matches(spark):
    r = random.Random(1)
    run = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(200_000))
    digests = ["".join(r.choice("0123456789abcdef") for _ in range(24)) for _ in range(20_000)]
    plain = ["".join(r.choice("ABCDEfghij0123456789KLMnopQRS") for _ in range(30)) for _ in range(20_000)]
    mixed = " ".join(x for pair in zip(digests, plain) for x in pair)
    start = time.perf_counter()
    found = {row.doc_id: row for row in secret_scan.scan(documents(spark, [(1, run), (2, mixed)])).collect()}
    assert time.perf_counter() - start < 90
    assert [(x.start, x.end) for x in found[1].extra] == [(0, 200_000)] and found[1].base == []
    base = [m.span() for m in re.finditer("[0-9a-f]{24,}", mixed)]
    assert [(x.start, x.end) for x in found[2].base] == base
    extra = [(x.start, x.end) for x in found[2].extra]
    spans = sorted(extra + base)
    assert len(extra) > 10_000 and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


# -- exact top k


@pytest.mark.parametrize("scale", [1e6, 3e4])
def test_large_components_have_exact_scores(spark, scale):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(0, scale, 64)).tolist()) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = [[int(np.floor(256 * x)) for x in v] for _, v in rows]
    found = top_k.exact_top_k(table, F.col("vec_id") % 5 == 0, 5).collect()
    assert len(found) == 12 * 5
    for q in range(0, 60, 5):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in range(60) if i != q)[:5]
        assert [(-row.score, row.vec_id) for row in sorted(found, key=lambda x: x["rank"]) if row.query_id == q] == scores


def test_scores_beyond_64_bits_are_an_error(spark):
    table = spark.createDataFrame([(0, [1e9] * 64), (1, [1e9] * 64)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        top_k.exact_top_k(table, F.col("vec_id") == 0, 1).collect()


# -- near copies, toxicity


def test_blank_rows_stay_whatever_their_ids(spark):
    text = prose(60, 21)
    rows = [(1, text), (2, text), (2, None), (3, " \n"), (3, text), (None, ""), (4, prose(60, 22))]
    kept = sorted(((r.doc_id, r.text) for r in similar.keep_one(documents(spark, rows)).collect()), key=str)
    assert kept == sorted([(1, text), (2, None), (3, " \n"), (None, ""), (4, prose(60, 22))], key=str)


def test_the_model_does_not_depend_on_the_order_of_rows(spark):
    rows = [(k, f"{'awful filth' if k % 2 else 'fine day'} {prose(12, 500 + k)}.") for k in range(60)]
    rows += [(k, f"{'fine day' if k % 2 else 'awful filth'} {prose(12, 700 + k)}.") for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, toxic int")
    models = [toxicity.train(documents(spark, order).repartition(n), labels) for n, order in ((1, rows), (5, rows[::-1]))]
    assert models[0].weights == models[1].weights and models[0].intercept == models[1].intercept
