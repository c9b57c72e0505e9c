from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lotseries.llm import packing, personal_data, pieces, secret_scan, toxicity, url_filter

from edge import ROWS, documents, nothing

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# -- URLs


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [
    ("http://a.example.NET/en/1?q#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("x://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("http://notexample.net", "notexample.net", "", None, "allow"),
    ("http://example.com/de/?x", "example.com", "/de/", "example.com/de/", "block"),
    ("http://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    ("http://org/fr/a://b", "org", "/fr/a://b", "org/fr/", "allow"),
    ("no scheme net/", "", "", None, "allow"),
    ("://net/#", "net", "/", "net/", "block"),
    ("http://net?/", "net", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


@pytest.mark.parametrize("most", [url_filter.MAX_MAPPED_RULES, 0])
def test_urls_are_judged(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MAX_MAPPED_RULES", most)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = [(k, u[0], "mine", 5) for k, u in enumerate(URLS * 2)] + [(None, "http://net/", "mine", 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, digest int")
    got = url_filter.judge_urls(pages, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            assert (r.url, r.host, r.path, r.rule, r.verdict) == URLS[r.page_id % len(URLS)]
    none = url_filter.judge_urls(pages, rules.limit(0)).select("verdict").distinct().collect()
    assert [r.verdict for r in none] == ["allow"]
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []


def test_equal_digests_are_told_apart_by_their_strings():
    keys = np.array([7, 7, 9], np.uint64)
    ends, text = np.array([0, 1, 2, 3]), np.frombuffer(b"abc", np.uint8)
    url = url_filter.xxhash.xxh64_intdigest
    try:
        url_filter.xxhash.xxh64_intdigest = lambda raw: 7 if raw in (b"a", b"b", b"z") else 9
        assert url_filter._lookup(keys, ends, text, [b"b", b"z", b"c", b"a"]).tolist() == [1, -1, 2, 0]
    finally:
        url_filter.xxhash.xxh64_intdigest = url


# -- secrets


def base_secrets(text):
    text, out = text or "", []
    assign = r"(?:%s)" % "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey")
    )
    for m in re.finditer(assign + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(1)) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def test_secrets_of_the_rules(spark):
    many = " ".join(f"token=abc{k:06}" for k in range(700))
    rows = [*ROWS, (20, many), (21, "é😀 secret: 'x' PASSWORD=tok_en.a=1 token=token=abcdefgh"), (22, "secret=token:abcdefgh")]
    got = secret_scan.scan(documents(spark, rows)).collect()
    assert len(got) == len(rows) and got[0].score == -1.0
    for r in got:
        assert [tuple(x) for x in r.base] == base_secrets(r.text), r.doc_id
    assert secret_scan.scan(nothing(spark)).collect() == []


def test_entropy_windows(spark):
    value = "aB3" + "x" * 15 + "Q9zT7kLm2PwR5vNc8YdF1g" + "x" * 10
    def bits(part):
        n = np.array([part.count(c) for c in set(part)]) / len(part)
        return -(n * np.log2(n)).sum()
    want = max(bits(value[i : i + 20]) for i in range(len(value) - 19))
    df = spark.createDataFrame([(value,)], "v string").select(secret_scan.best_window_bits(F.col("v"), 20).alias("b"))
    assert np.isclose(df.first().b, want)
    texts = [
        (1, "key Q9zT7kLm2PwR5vNc8YdF1gH4 end"),
        (2, "EXAMPLEQ9zT7kLm2PwR5vNc8YdF1gH4"),
        (3, "id 123e4567-e89b-12d3-a456-426614174000"),
        (4, "aaaaaaaaaaaaaaaaaaaaaaaa1A"),
        (5, "token=Q9zT7kLm2PwR5vNc8YdF1gH4"),
    ]
    extra = {r.doc_id: [(x.start, x.end) for x in r.extra] for r in secret_scan.scan(documents(spark, texts)).collect()}
    assert extra == {1: [(4, 28)], 2: [], 3: [], 4: [], 5: []}


# -- personal data


def test_rules_of_personal_data_and_added_spans(spark):
    r = np.random.default_rng(3)
    rows = list(ROWS)
    for k in range(200):
        rows.append((100 + k, f"some words {k} call +1 ({r.integers(200, 999)}) 555-{r.integers(1000, 9999)} and then 12.{k}.3.4 or {r.integers(10**11, 10**12)}"))
    rows.append((900, "call +1 (269) 555-3296 4524132264652876 now"))  # too long together for a phone number
    docs = documents(spark, rows)
    selector = personal_data.train(docs)
    found = personal_data.find(docs, selector).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id == 12:
            assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
            assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()
        if row.doc_id == 900:
            assert (row.n_phone, row.n_card) == (0, 0) and row.spans == "phone:5:22"
        if row.doc_id in (7, 8, 9, 6):
            assert row.spans == "" and row.base_sha256 == hashlib.sha256(b"").hexdigest()
    masked = personal_data.redact(docs, selector)
    assert masked.columns == docs.columns
    by_row = {x.row_no: x for x in masked.collect()}
    assert by_row[11].text == "Mail [EMAIL], call [PHONE] or [IP]; card [CARD] here." and by_row[11].n_chars == len(by_row[11].text)
    assert by_row[5].text == ROWS[5][1] and by_row[6].text is None
    none = personal_data.train(nothing(spark))
    assert none.trees is None and personal_data.find(nothing(spark), none).collect() == []


def test_emails_are_those_of_a_plain_search():
    text = "a@b a@b.c@d.e .x@y.z, @a.b a@@b.c é@b.c x.é%y@q-1.w_e a@b..c"
    assert [text[a:b] for a, b in personal_data._emails(text)] == [m.group() for m in personal_data._EMAIL.finditer(text)]


def test_trees_learn():
    r = np.random.default_rng(5)
    x = r.integers(0, 9, (3000, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 4)).astype(float)
    trees = personal_data.Trees().fit(x[:2000], y[:2000])
    assert ((trees.raw(x[2000:]) > 0) == y[2000:]).mean() > 0.98


# -- toxicity


def test_sentences_are_found_from_document_labels(spark):
    r = np.random.default_rng(6)
    words = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(900):
        sentences = [" ".join(r.choice(words, 8)) for _ in range(6)]
        if k % 3 == 0:
            sentences[k % 6] += " nasty" + "".join(r.choice(list("xyz"), 2))
        rows.append((k, ". ".join(sentences) + "."))
        labels.append((k, int(k % 3 == 0)))
    rows += [(2000 + (i or 0), t) for i, t in ROWS]
    docs = documents(spark, rows)
    known = spark.createDataFrame([*labels, (None, 1), (5, None), (6, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, known)
    got = {x.doc_id: x for x in toxicity.score_documents(docs, model).collect()}
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 3 == 1]
    right = sum((got[k].score >= 0.7) == (k % 3 == 0) for k in held)
    assert right / len(held) > 0.97
    for k in (x for x in held if x % 3 == 0 and got[x].score >= 0.7):
        text = rows[k][1]
        assert any("nasty" in text[s.start : s.end] for s in got[k].offending)
    assert got[2007].score == got[2008].score == 0.0
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id >= 2000").count() == len(ROWS)
    none = toxicity.train(nothing(spark), known)
    assert toxicity.score_documents(docs, none).where("score > 0").count() == 0


# -- packing


def test_packing_holds_every_id_once(spark):
    from tokenizers import Tokenizer

    docs = documents(spark)
    limit = 512
    rows = packing.pack(docs, WORD_BPE, limit, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want, got = [], {}
    for i, t in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k // limit, k, tuple(ids[k : k + limit])) for k in range(0, len(ids), limit)]
    assert sorted(((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in rows), key=str) == sorted(want, key=str)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in got.values():
        ends = np.cumsum([0, *[n for _, n in sorted(places)]])
        assert [a for a, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= limit
    total = sum(r.length for r in rows)
    assert len(got) <= -(-total // limit) + 1
    assert packing.pack(nothing(spark), WORD_BPE).collect() == []


def test_the_plan_is_best_fit_decreasing():
    r = np.random.default_rng(7)
    for _ in range(20):
        lengths = np.sort(r.integers(1, 101, 300))[::-1]
        room: list[int] = []
        for n in lengths.tolist():
            fit = min((x for x in range(len(room)) if room[x] >= n), key=lambda x: room[x], default=None)
            if fit is None:
                room.append(100 - n)
            else:
                room[fit] -= n
        counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        plan = packing.plan_best_fit(counts, 100)
        made = {s + (k - a) // e for _, a, b, s, e, _ in plan for k in range(a, b + 1)}
        assert len(made) == len(room)


def test_words_get_the_tokenizers_own_ids():
    words = packing.WordIds(WORD_BPE)
    texts = ["A<|endoftext|>b İstanbul ΟΔΟΣ e\u0301te\u0301 ﬁne it's don't x.y, ,. ... 12ab\u00a0c\n\nd", "", " "]
    for text, ids in zip(texts, words.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


# -- pieces


@pytest.mark.parametrize("shipped", [pieces.MAX_SHIPPED, 20])
def test_pieces_are_the_librarys_and_decode_to_the_text(spark, monkeypatch, shipped):
    import sentencepiece

    monkeypatch.setattr(pieces, "MAX_SHIPPED", shipped)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [*ROWS, (30, " Été — ¡ñ! \u4e2d\u6587 \U0001f600\r\n\ttab  two   blanks  x=1.5e3 ## "), (31, "\u2028\x00z")]
    rows = [(i, t if t is None or len(t) < 100_000 else t[:100_000]) for i, t in rows]
    docs = documents(spark, rows)
    encoded = pieces.encode(docs, PIECES)
    got = pieces.decode(encoded, PIECES).collect()
    want = sorted(((i, tuple(library.encode(t or "")), t or "") for i, t in rows), key=str)
    assert sorted(((r.doc_id, tuple(r.ids), r.text) for r in got), key=str) == want
    assert pieces.encode(nothing(spark), PIECES).collect() == []


def test_a_worker_remembers_little(monkeypatch):
    import tracemalloc

    vocabulary = pieces.Vocabulary(PIECES)
    tracemalloc.start()
    found = [len(vocabulary.split(f"\u2581w{i:x}q")) for i in range(210_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25_000_000
    monkeypatch.setattr(pieces, "MOST_KEPT", 0)
    other = pieces.Vocabulary(PIECES)
    assert found[::5000] == [len(other.split(f"\u2581w{i:x}q")) for i in range(0, 210_000, 5000)]


def test_the_fold_is_viterbi(spark):
    class Words(pieces.Vocabulary):
        def __init__(self):
            self.normal = [("a", 0, -3.0), ("b", 1, -3.5), ("ab", 2, -5.0), ("ba", 3, -6.0), ("aba", 4, -9.0), ("bab", 5, -7.9)]
            self.bytes, self.unknown, self.longest, self.merges = {}, 9, 3, False
            self.unknown_score = -19.0

    words, scores = Words(), {p: s for p, _, s in Words().normal}
    r = np.random.default_rng(8)
    units = ["".join(r.choice(list("abz"), r.integers(1, 12))) for _ in range(60)]

    def brute(unit):
        best = [(0.0, ())]
        for end in range(1, len(unit) + 1):
            options = []
            for size in range(1, min(3, end) + 1):
                piece = unit[end - size : end]
                if piece in scores or size == 1:
                    options.append((best[end - size][0] + scores.get(piece, -19.0), size, best[end - size][1] + (piece,)))
            s, _, path = max(options, key=lambda o: (o[0], o[1]))
            best.append((s, path))
        return [next((i for p, i, _ in words.normal if p == x), 9) for x in best[-1][1]]

    df = spark.createDataFrame([(u, 1) for u in set(units)], "unit string, amount bigint")
    edges = pieces.lattice(df, words).groupBy("unit").agg(F.collect_list(F.struct("end", "size", "score", "ids")).alias("e"))
    for row in edges.select("unit", pieces.viterbi(F.col("e"), 3).alias("ids")).collect():
        assert row.ids == brute(row.unit), row.unit
