from __future__ import annotations

import re
from itertools import combinations

import numpy as np

from lotseries.llm import shingles, similar, substrings

from edge import ROWS, documents, nothing, prose


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", low) if w]


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if label[m] == label[k] and rows[m][0] is not None]
        out.append((i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i))
    return sorted(out, key=str)


def test_components_are_those_of_all_links(spark):
    rows = list(ROWS)
    base = prose(200, 20).split()
    for k in range(40):  # a group of near copies, some of them not similar enough
        changed = list(base)
        for place in range(5, 5 + 45 * (k % 6), 45):
            changed[place] = f"w{k}x{place}"
        rows.append((100 + k, " ".join(changed)))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar.similarity_classes(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_nothing_is_similar_to_nothing(spark):
    assert similar.similarity_classes(nothing(spark)).collect() == []
    assert similar.keep_one(nothing(spark)).collect() == []
    assert substrings.find_repeats(nothing(spark)).collect() == []


def test_one_row_of_each_component_stays(spark):
    docs = documents(spark)
    kept = similar.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(1) == 1 and not {2, 3, 11} & set(ids)  # copies and near copies of 1 and 10
    assert {7, 8, 9} <= set(ids) and ids.count(None) == 1
    assert sorted(ids, key=str) == sorted([1, 4, 5, 5, 6, 7, 8, 9, 10, 12, 13, 14, 15, None], key=str)


def test_lists_in_blocks_give_the_same_pairs(spark, monkeypatch):
    rows = [(k, " ".join([*prose(60, 30).split(), f"a{k}", f"b{k}", f"c{k}"])) for k in range(30)]
    want = brute(rows)
    monkeypatch.setattr(similar.Frequencies, "lists", lambda self, s: np.full(len(s), 3.0 * similar.LIST_BLOCK))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar.similarity_classes(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == want


def test_prefixes_get_longer_where_lists_are_long():
    rare, often = np.ones(100), np.r_[np.ones(18), np.full(82, 1000.0)]
    assert similar.matches_wanted(often, 100) > 1
    assert 1 <= similar.matches_wanted(rare, 100) <= similar.MOST_MATCHES
    assert similar.matches_wanted(np.ones(1), 1) == 1


def test_components_of_a_chain_and_a_star(spark):
    links = [(bytes([k]), bytes([k + 1])) for k in range(20)] + [(b"\x64", bytes([k])) for k in range(101, 130)]
    df = spark.createDataFrame([tuple(map(bytearray, x)) for x in links], "a binary, b binary")
    got = {bytes(r.node): bytes(r.component) for r in shingles.components(df).collect()}
    assert {got[bytes([k])] for k in range(1, 21)} == {b"\x00"} and {got[bytes([k])] for k in range(101, 130)} == {b"\x64"}


def test_windows_hold_the_minimum_of_every_passage():
    r = np.random.default_rng(4)
    tokens = r.integers(0, 40, 500).astype(np.uint64)
    ends = np.array([200, 230, 500])
    place, _ = substrings.compact_windows(tokens, ends, 1)
    hashes = shingles.mixed(tokens ^ substrings._seed(1))
    starts = [s for a, b in ((0, 200), (200, 230), (230, 500)) for s in range(a, b - substrings.WIDTH + 1)]
    for s in starts:
        window = hashes[s : s + substrings.WIDTH]
        inside = place[(place >= s) & (place < s + substrings.WIDTH)]
        assert (hashes[inside] >> np.uint64(16)).min() == (window >> np.uint64(16)).min()
    edges = ~((ends[:, None] > place) & (ends[:, None] - place < 1)).any()
    assert edges


def repeated(rows):
    """Words of a row within fifty that a document of smaller id has as well."""
    first = {}
    for i, t in sorted({(i, t) for i, t in rows if i is not None}, key=lambda r: (r[0], r[1] or "")):
        w = words(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), (i, t))
    out = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])][0] < i:
                out.setdefault((i, t), set()).update(range(k, k + 50))
    return out


def test_every_repeated_passage_is_found(spark):
    docs = documents(spark)
    got = {}
    texts = {i: t for i, t in ROWS}
    for r in substrings.find_repeats(docs).collect():
        got.setdefault(r.doc_id, set()).update(range(r.first_word, r.end_word))
        assert r.source_id is None or r.source_id <= r.doc_id
    for (i, t), places in repeated(ROWS).items():
        if texts[i] == t:
            assert places <= got.get(i, set()), i
    assert set(got) <= {2, 3, 5}  # nothing else is similar to anything
    assert max(got[5]) - min(got[5]) + 1 == 70


def test_repeats_are_cut_out_but_once(spark):
    docs = documents(spark)
    after = substrings.remove_repeats(docs)
    assert after.columns == docs.columns
    old, new = {r.row_no: r for r in docs.collect()}, {r.row_no: r for r in after.collect()}
    assert old.keys() == new.keys()
    changed = {old[k].doc_id for k in old if old[k].text != new[k].text}
    assert changed == {2, 3, 5}
    for r in new.values():
        assert r.text is None or r.n_chars == len(r.text)
    assert words(new[4].text) == words(prose(80, 6) + " " + prose(20, 7))
    assert new[5].text == old[5].text and new[6].text is None


def test_a_changed_word_does_not_hide_a_passage():
    a = np.arange(120, dtype=np.uint32)
    b = a.copy()
    b[60:65] = 900 + np.arange(5)
    assert substrings.repeats_between(a, b, [(3, 3)]) == [(0, 120, 0, 120)]
    assert substrings.repeats_between(a, np.r_[np.arange(500, 530), a[:40]].astype(np.uint32), [(5, 35)]) == []


def test_a_passage_is_one_row_with_all_its_sources(spark):
    shared = prose(70, 41)
    rows = [(k, f"{prose(30, 50 + k)} {shared} {prose(20, 60 + k)}") for k in range(4)]
    rows.append((9, " ".join(shared.split()[5:60]) + " " + prose(30, 70)))
    found = substrings.find_repeats(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 3, 9]
    for r in found:
        assert r.source_id < r.doc_id and r.first_word == (30 if r.doc_id < 9 else 0)
        assert {x.source_id for x in r.links} >= {r.source_id}
        assert all(r.first_word <= x.first_word and x.end_word <= r.end_word for x in r.links)
    together = substrings.find_repeats(documents(spark, rows).coalesce(1)).collect()
    assert {r.doc_id: {x.source_id for x in r.links} for r in together} == {1: {0}, 2: {0, 1}, 3: {0, 2}, 9: {0, 3}}


def test_longest_passages():
    p = lambda a, b, s: (a, b, s, b"w", 0, b - a)
    found = substrings.longest_passages([p(5, 60, 2), p(0, 70, 3), p(0, 70, 1), p(20, 90, None), p(80, 90, 4), p(100, 150, 5)])
    assert [(x[0], x[1], x[2], [y[2] for y in links]) for x, links in found] == [
        (0, 70, 1, [1, 3, 2]), (20, 90, None, [None, 4]), (100, 150, 5, [5])
    ]
