"""Toxicity by multiple-instance learning: sentences are scored, documents labelled.

A document is toxic if one of its sentences is: with sentence probabilities ``p`` its probability
is the noisy-or ``1 - prod(1 - p)``. Sentence scores are logistic in the word and character-gram
features that toxic training documents have more often than others; weights are fitted to document labels through the
noisy-or, so the model learns which sentences offend though none is marked.

Training takes at most ``SAMPLE`` labelled documents (those of smallest id hash); all else covers
every document and whole texts.

Defined results: null and empty texts have no sentence and score 0;
repeated rows are scored one by one; null ids are scored but never trained on; of several labels
of one id the largest counts, null labels count for nothing; without toxic or without clean training documents
all scores are 0. Other columns of any name stay as they are; result columns replace theirs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, map_batches, texts_of

SAMPLE = 12_000
FEATURES = 2_000
LEAST_DOCUMENTS = 4  # training documents a feature must occur in
LEAST_Z = 4.0
LEAST_LIFT = 4.0  # times the share of clean documents
THRESHOLD = 0.7
OFFENDING = 0.5
GRAMS = (3, 4, 5)
# Toxic and clean documents from which features are drawn; their counts come from all of the sample.
DRAWN = 1_500

_BREAK = re.compile(r"[.!?\n]+")
_NO_WORD = re.compile(r"\W")


def held_out(doc_id: Column) -> Column:
    """Rows that are never trained on."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def _flat(text: str) -> str:
    """Lower-cased words between blanks, with every character of ``text`` one place further on."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return f" {_NO_WORD.sub(' ', low)} "


def _breaks(text: str) -> list[tuple[int, int]]:
    """Where sentences are parted; a text that is not empty has one sentence more than breaks."""
    return [m.span() for m in _BREAK.finditer(text)]


def _features(flat: str) -> set[str]:
    """Words with the blanks around them, and character grams, of which only the ends may be blanks."""
    found = set()
    for word in set(flat.split()):
        marked = f" {word} "
        found.add(marked)
        for n in GRAMS:
            found.update(marked[i : i + n] for i in range(len(marked) - n + 1))
    return found


def _once(sentence: np.ndarray, feature: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """A feature counts once in a sentence, however often it is repeated there."""
    return np.divmod(np.unique(sentence * features + feature), features)


class NoisyOr:
    """Weights of the features and the intercept of a sentence."""

    def __init__(self, weights: dict[str, float], intercept: float) -> None:
        self.weights, self.intercept = weights, intercept
        self.names = list(weights)
        self.values = np.array(list(weights.values()))
        self.finder = None

    def __getstate__(self) -> tuple:
        return self.weights, self.intercept

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ends (in ``text``) and numbers of all features that occur, found in one pass."""
        import ahocorasick

        if self.finder is None:
            self.finder = ahocorasick.Automaton()
            for i, name in enumerate(self.names):
                self.finder.add_word(name, i)
            self.finder.make_automaton()
        found = list(self.finder.iter(_flat(text)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, which = np.array(found, np.int64).T
        return np.minimum(np.maximum(ends - 1, 0), len(text) - 1), which

    def sentences(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of the text, and ``(start, end, probability)`` of its sentences above ``OFFENDING``."""
        if not self.names or not text:
            return 0.0, []
        ends, which = self.matches(text)
        n = len(_BREAK.findall(text)) + 1
        if not len(ends):
            return float(-np.expm1(n * np.log1p(-1 / (1 + np.exp(-self.intercept))))), []
        breaks = _breaks(text)
        last = np.array([b for _, b in breaks] + [len(text)])
        of = np.searchsorted(last, ends, side="right").clip(max=n - 1)
        of, which = _once(of, which, len(self.names))
        z = self.intercept + np.bincount(of, self.values[which], n)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        first = [0, *last[:-1].tolist()]
        spans = [(first[i], breaks[i][0] if i < len(breaks) else len(text), float(p[i])) for i in np.flatnonzero(p >= OFFENDING)]
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), spans


def _select(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Features that toxic documents have significantly and several times more often."""

    def z(bad: int, clean: int, n1: int, n0: int) -> float:
        share = (clean + bad) / (n0 + n1)
        if bad / n1 < LEAST_LIFT * clean / n0:
            return 0.0
        return (bad / n1 - clean / n0) / np.sqrt(max(share * (1 - share), 1e-9) * (1 / n0 + 1 / n1))

    drawn = [np.flatnonzero(toxic == y)[:DRAWN] for y in (0, 1)]
    counts: tuple[dict[str, int], dict[str, int]] = ({}, {})
    for into, chosen in zip(counts, drawn):
        for i in chosen:
            for f in _features(_flat(texts[i])):
                into[f] = into.get(f, 0) + 1
    sizes = len(drawn[1]), len(drawn[0])
    rough = [(z(n, counts[0].get(f, 0), *sizes), f) for f, n in counts[1].items() if n >= LEAST_DOCUMENTS]
    rough = [f for x, f in sorted(rough, key=lambda r: (-r[0], r[1]))[: 2 * FEATURES] if x >= LEAST_Z / 2]
    finder = NoisyOr(dict.fromkeys(rough, 1.0), 0.0)
    table = np.zeros((2, len(rough)), np.int64)
    for text, y in zip(texts, toxic):
        if text and rough:
            table[y, np.unique(finder.matches(text)[1])] += 1
    n1, n0 = int(toxic.sum()), int((1 - toxic).sum())
    scored = [(-z(int(table[1, i]), int(table[0, i]), n1, n0), f) for i, f in enumerate(rough)]
    return [f for x, f in sorted(scored)[:FEATURES] if -x >= LEAST_Z]


def fit(texts: list[str], labels: list[int], steps: int = 250, shrink: float = 1e-4) -> NoisyOr:
    """Fit the weights to document labels through the noisy-or, by Adam over all sentences."""
    toxic = np.array(labels, np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return NoisyOr({}, -40.0)
    names = _select(texts, toxic)
    if not names:
        return NoisyOr({}, -40.0)
    finder = NoisyOr(dict.fromkeys(names, 1.0), 0.0)
    owner, sentence, feature, plain, made = [], [], [], np.zeros(len(texts)), 0
    for d, text in enumerate(texts):
        ends, which = finder.matches(text)
        last = np.array([b for _, b in _breaks(text)] + [len(text)])
        of, which = _once(np.searchsorted(last, ends, side="right").clip(max=len(last) - 1), which, len(names))
        of, own = np.unique(of, return_inverse=True)
        plain[d] = len(last) - len(of)  # scored by the intercept alone
        owner.append(np.full(len(of), d))
        sentence.append(own + made)
        feature.append(which)
        made += len(of)
    owner, sentence, feature = (np.concatenate(x).astype(np.int64) for x in (owner, sentence, feature))
    n, k = len(texts), len(names)
    w, b = np.full(k, 0.05), -6.0
    m, v, mb, vb = np.zeros(k), np.zeros(k), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.clip(b + np.bincount(sentence, w[feature], len(owner)), -30, 30)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-b))
        none = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), n) + plain * np.log1p(-p0)
        whole = np.clip(-np.expm1(none), 1e-9, 1 - 1e-9)
        # d loss / d z of a sentence: p for clean documents, -p (1 - P) / P for toxic ones.
        pull = np.where(toxic == 1, -(1 - whole) / whole, 1.0) / n
        dz = pull[owner] * p
        g = np.bincount(feature, dz[sentence], k) + shrink * w
        gb = dz.sum() + (pull * plain * p0).sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        b -= 0.05 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-9)
    return NoisyOr({f: float(x) for f, x in zip(names, w) if abs(x) > 1e-3}, float(b))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> NoisyOr:
    """Fit on at most ``sample`` labelled documents outside the held-out third."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # The sample is bounded, so is its broadcast; documents are filtered where they are read.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")
        .where(F.length("text") > 0)
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))  # of several texts of an id the smallest
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic += batch.column(1).to_pylist()
        model = fit(texts, toxic)
        names = ["", *model.weights]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([model.intercept, *model.weights.values()], pa.float64())], ["f", "w"]
        )
        del texts, toxic
        give_back()

    fitted = rows.select("text", "toxic").mapInArrow(learn, "f string, w double").collect()  # FEATURES rows
    weights = {row.f: row.w for row in fitted}
    return NoisyOr({f: w for f, w in weights.items() if f}, weights.get("", -40.0))


def score_documents(docs: DataFrame, model: NoisyOr) -> DataFrame:
    """``doc_id, score, offending``: offending sentences as ``(start, end, probability)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores, spans = [], []
        for text in texts_of(batch.column(1)):
            whole, found = shared.value.sentences(text)
            scores.append(whole)
            spans.append([{"start": a, "end": b, "probability": p} for a, b, p in found])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "offending"]
        )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, score double, offending array<struct<start:int,end:int,probability:double>>"
    return map_batches(docs.select("doc_id", "text"), score, schema)


def keep_clean(docs: DataFrame, model: NoisyOr, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose texts score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        good = [shared.value.sentences(text)[0] < threshold for text in texts_of(batch.column(at))]
        yield batch.filter(pa.array(good, pa.bool_()))

    return map_batches(docs, keep, docs.schema)
