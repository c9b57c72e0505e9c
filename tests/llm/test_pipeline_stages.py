"""Every stage of the pipeline against brute force, each on what the stage before has left."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lotseries.llm import personal_data, toxicity
from lotseries.sources.stored import stored

DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DIR.exists(), reason="test tables are not there")
STAGES = dict(corpus_pipeline.STAGES)


def words(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def tables(spark):
    """What goes into each stage, and what comes out of the last."""
    docs, found = spark.read.parquet(str(DIR / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs
        docs = stored(stage(spark, docs, str(DIR)))
    return found | {"end": docs}


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def after(tables, name):
    names = [*STAGES, "end"]
    return tables[names[names.index(name) + 1]]


def test_toxicity_is_the_noisy_or_of_the_sentences(spark, tables):
    docs = tables["toxicity"]
    model = toxicity.train(docs, spark.read.parquet(str(DIR / "labels.parquet")))
    kept = rows_of(after(tables, "toxicity"))
    for r in docs.collect():
        whole, sentences = model.sentences(r.text or "")
        assert 0 <= whole <= 1 and all(0 <= p <= whole + 1e-9 for _, _, p in sentences)
        if len(sentences) > 1:
            assert whole >= 1 - math.prod(1 - p for _, _, p in sentences) - 1e-9
        assert (r.doc_id in kept) == (whole < toxicity.THRESHOLD)


def test_one_of_each_group_of_near_copies_stays(tables):
    docs, kept = rows_of(tables["near_copies"]), rows_of(after(tables, "near_copies"))
    sets = {i: shingles(r.text) for i, r in docs.items()}
    label = {i: i for i in docs}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(i for i in docs if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if min(len(sets[a]), len(sets[b])) * 100 >= 80 * max(len(sets[a]), len(sets[b])):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    assert set(kept) == {i for i in docs if not sets[i] or root(i) == i}
    assert all(kept[i] == docs[i] for i in kept) and len(kept) < len(docs)


def test_no_passage_of_fifty_words_is_left_twice(tables):
    docs, kept = rows_of(tables["repeated_passages"]), rows_of(after(tables, "repeated_passages"))
    assert docs.keys() == kept.keys()

    def owners(rows):
        found = {}
        for i, r in rows.items():
            w = words(r.text)
            for k in range(len(w) - 49):
                found.setdefault(tuple(w[k : k + 50]), set()).add(i)
        return {p: o for p, o in found.items() if len(o) > 1}

    repeated = owners(docs)
    assert not owners(kept)
    for i, r in kept.items():
        lost = Counter(words(docs[i].text)) - Counter(words(r.text))
        if lost:
            assert r.n_chars == len(r.text)
        # near passages may go too, but nothing of a text that shares less than a passage could
        others = set().union(*(shingles(x.text) for j, x in docs.items() if j < i))
        if len(shingles(docs[i].text) & others) < 25:
            assert r == docs[i]
    assert repeated


def test_what_the_rules_find_is_masked(tables):
    docs, kept = rows_of(tables["personal_data"]), rows_of(after(tables, "personal_data"))
    assert docs.keys() == kept.keys()
    masked = 0
    for i, r in docs.items():
        base = personal_data.base_spans(r.text or "")
        assert not personal_data.base_spans(kept[i].text or "")
        if not base and not personal_data.proposed(r.text or ""):
            assert kept[i] == r
        masked += bool(base)
    assert masked


def test_packed_pieces_are_the_tokens_of_the_documents(tables):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs, pieces = rows_of(tables["packing"]), tables["end"].collect()
    lengths = {i: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in docs.items()}
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
        assert p.start == 4096 * p.piece and p.length <= 4096
    assert got == Counter(lengths)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:k]) for k in range(len(places))]
    room: list[int] = []  # first fit, longest first
    for n in sorted((p.length for p in pieces), reverse=True):
        at = next((k for k, free in enumerate(room) if free >= n), None)
        if at is None:
            room.append(4096 - n)
        else:
            room[at] -= n
    assert max(sum(n for _, n in x) for x in sequences.values()) <= 4096 and len(sequences) <= len(room)
