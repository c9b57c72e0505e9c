from __future__ import annotations

import hashlib
import random
import re

import pytest
from edge import ROWS, documents, nothing
from pyspark.sql import functions as F

from lotseries.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_unit_ends_in_runs_of_any_length():
    r = random.Random(2)
    for _ in range(500):
        text = "".join(r.choice("ab \n\té😀\x85\xa0\x00") for _ in range(r.randint(0, 40)))
        want = [m.end() for m in UNIT.finditer(text)]
        for run in (1, 3, 7, 100):
            assert fill_middle.unit_ends(text, run).tolist() == want


def test_equals_brute_force_and_comes_back(spark):
    r = random.Random(4)
    alphabet = ["a", "bc", "é", "😀", " ", "  ", "\n", "<P", ">", "<", "S>", "\x85"]
    more = [(100 + i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 30)))) for i in range(400)]
    rows = [*ROWS, *more, (900, "has <P> in it"), (901, "<M>"), (902, "   ")]
    found = fill_middle.fill_in_middle(documents(spark, rows))
    back = found.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted((tuple(row)[:6] for row in back), key=key) == sorted((plainly(i, t) for i, t in rows), key=key)
    assert sorted(row.back for row in back) == sorted(t or "" for _, t in rows)
    assert {row.form for row in back} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("percent,first,form", [(100, 100, "spm"), (100, 0, "psm"), (0, 50, "plain")])
def test_shares_are_parameters(spark, percent, first, form):
    rows = [(i, "some words here") for i in range(20)]
    found = fill_middle.fill_in_middle(documents(spark, rows), 7, percent, first)
    assert {row.form for row in found.collect()} == {form}


def test_very_long_text_is_matched_in_runs(spark):
    rows = [(i, " ".join(["word"] * 700_000)) for i in range(4)] + [(9, "x" * 3_000_000)]
    found = fill_middle.fill_in_middle(documents(spark, rows), percent=100)
    back = found.select("doc_id", "n", (F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256)).alias("h"))
    want = {(i, 700_000 if i < 9 else 1, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows}
    assert {tuple(row) for row in back.collect()} == want


def test_empty_table(spark):
    assert fill_middle.fill_in_middle(nothing(spark)).collect() == []
