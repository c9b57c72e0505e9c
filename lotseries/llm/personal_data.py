"""Personal data: fixed rules, and boosted trees over the spans of high-recall generators.

The rules find well-formed e-mail addresses, IP addresses, card and phone numbers. Generators
propose many more spans that may overlap: every short sequence of digit groups, dotted numbers,
written-out addresses. Boosted trees score a span by its format and its context. They learn from a bounded
sample in which a proposed span counts as right if the rules accept just that span, or if it is an address
with a marked, written-out ``at`` that the rules would accept. Scores are calibrated on all documents the trees
have not seen: per kind the threshold is the lowest one that keeps the wanted precision there. Spans above it are
added where they overlap no other.

Defined results: null and empty texts have no spans and the digest of the empty string; repeated
rows are treated one by one; null ids are kept but not trained on; an empty table, or one without
examples of both sorts, adds no spans. Offsets are code points, ends exclusive. Other columns of
any name stay as they are.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts_of

KINDS = ["email", "ip", "card", "phone"]
# Documents (about so many) and proposed spans (at most) the trees are fitted on.
SAMPLE_DOCUMENTS = 20_000
SAMPLE_SPANS = 20_000
SPANS_A_DOCUMENT = 50
PRECISION = 0.98
# Histogram of raw scores: bins to a unit, and the last bin on either side.
BINS_A_UNIT = 50
BIN_END = 2_000

Span = tuple[str, int, int]

# The rules.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_NUMBERS = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])+")
_GROUP = re.compile(r"\+?\(?[0-9]+\)?")
_WRITTEN = re.compile(
    r"[\w.%+-]{1,64} ?(?:@|\(at\)|\[at\]| at ) ?[\w-]{1,64}(?:(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?)[\w-]{1,64}){1,4}"
)
_AT = re.compile(r" ?(?:\(at\)|\[at\]) ?")
_DOT = re.compile(r" ?(?:\(dot\)|\[dot\]| dot ) ?")
LONGEST = 48
GROUPS = 5
# Spans scored at once.
RUN_SPANS = 10_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As a search from the left would find them, but looking only around each ``@``."""
    end = 0
    at = text.find("@")
    while at >= 0:
        first = at
        while first > end and (text[first - 1].isascii() and (text[first - 1].isalnum() or text[first - 1] in "._%+-")):
            first -= 1
        m = _EMAIL.match(text, first) if first < at else None
        if m:
            end = m.end()
            yield m.span()
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """What the rules find, by kind and then start."""
    spans: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    spans += [
        ("ip", *m.span()) for m in _IP.finditer(text) if all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in m.group().split("."))
    ]
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return spans


def proposed(text: str) -> list[Span]:
    """Spans of the generators; they may overlap."""
    spans = set()
    if _DIGIT.search(text):
        for run in _NUMBERS.finditer(text):
            groups = [(m.start() + run.start(), m.end() + run.start()) for m in _GROUP.finditer(run.group())]
            for i, (first, _) in enumerate(groups):
                for _, last in groups[i : i + GROUPS]:
                    if last - first <= LONGEST and (n := len(digits_of(text[first:last]))) >= 7:
                        dotted = text[first:last].count(".") == 3 and n <= 12
                        spans.add(("ip" if dotted else "card" if n >= 12 else "phone", first, last))
    if "@" in text or " dot " in text or "(at)" in text or "[at]" in text:
        spans.update(("email", *m.span()) for m in _WRITTEN.finditer(text) if m.end() - m.start() <= 2 * LONGEST)
    return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def _sort_of(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isdigit() else 2 if c.isalpha() else 3 if c in "+(" else 4


def features(text: str, span: Span) -> list[float]:
    """Format of the span, then its context."""
    kind, a, b = span
    part = text[a:b]
    digits = digits_of(part)
    groups = _GROUP.findall(part)
    before = text[max(0, a - 24) : a].split(" ")
    after = text[b : b + 24].split(" ")
    numbers = [len(digits_of(g)) for g in groups] or [0]
    return [
        KINDS.index(kind),
        b - a,
        len(digits),
        len(groups),
        numbers[0],
        numbers[-1],
        max(numbers),
        part.startswith("+"),
        part.count("(") - part.count(")"),
        part.count("("),
        part.count("."),
        part.count("-"),
        part.count(" "),
        part.count("@"),
        kind == "card" and luhn(digits),
        max([int(g) for g in re.findall(r"[0-9]{1,9}", part)], default=0) if kind == "ip" else 0,
        _sort_of(text[a - 1 : a]),
        _sort_of(text[b : b + 1]),
        len(before[-1]),
        _sort_of(before[-2][-1:] if len(before) > 1 else ""),
        bool(re.search(r"(?i)tel|phone|call|fax|mobil", " ".join(before))),
        bool(re.search(r"(?i)card|visa|konto|account|iban", " ".join(before))),
        bool(re.search(r"(?i)mail|contact|write", " ".join(before))),
        bool(re.search(r"(?i)version|isbn|page|id|nr|no\.?$", " ".join(before))),
        len(after[0]),
        _sort_of(after[1][:1] if len(after) > 1 else ""),
    ]


class Trees:
    """Gradient-boosted trees of depth three for the logistic loss."""

    def __init__(self, rounds: int = 40, rate: float = 0.3, depth: int = 3) -> None:
        self.rounds, self.rate, self.depth = rounds, rate, depth
        self.trees: list[list[tuple]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1])) for j in range(x.shape[1])]
        raw = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            tree: list[tuple] = []
            self._grow(tree, x, y - p, p * (1 - p), np.arange(len(y)), cuts, self.depth)
            self.trees.append(tree)
            raw += self._leaf(tree, x)
        return self

    def _grow(self, tree: list[tuple], x, g, h, rows, cuts, depth) -> int:
        """Nodes ``(feature, cut, left, right, value)``; a leaf has feature -1."""
        at = len(tree)
        value = self.rate * g[rows].sum() / (h[rows].sum() + 1.0)
        tree.append((-1, 0.0, 0, 0, value))
        if depth == 0 or len(rows) < 20:
            return at
        best = (1e-6, 0, 0.0)
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for j, points in enumerate(cuts):
            where = np.searchsorted(points, x[rows, j])
            gs = np.cumsum(np.bincount(where, g[rows], len(points) + 1))
            hs = np.cumsum(np.bincount(where, h[rows], len(points) + 1))
            gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - whole
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), j, points[int(gain.argmax())])
        if best[0] > 1e-6:
            left = x[rows, best[1]] <= best[2]
            if left.any() and not left.all():
                a = self._grow(tree, x, g, h, rows[left], cuts, depth - 1)
                b = self._grow(tree, x, g, h, rows[~left], cuts, depth - 1)
                tree[at] = (best[1], best[2], a, b, value)
        return at

    def _leaf(self, tree: list[tuple], x: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = (np.array(c) for c in zip(*tree))
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            f = feature[node]
            inner = f >= 0
            goes = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= cut[node], left[node], right[node])
            node = np.where(inner, goes, node)
        return value[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((self._leaf(t, x) for t in self.trees), np.zeros(len(x)))


def apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that overlap none of ``base``: none that starts before their end ends behind their start."""
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    furthest = list(itertools.accumulate((b for _, b in taken), max))
    return [s for s in spans if not (at := bisect.bisect_left(starts, s[2])) or furthest[at - 1] <= s[1]]


class Selector:
    """Trees with one score threshold per kind; without a model it selects nothing."""

    def __init__(self, trees: Trees | None = None, thresholds: dict[str, float] | None = None) -> None:
        self.trees, self.thresholds = trees, thresholds or {}

    def added(self, text: str, base: list[Span]) -> list[Span]:
        if self.trees is None or not (spans := proposed(text)):
            return []
        spans = apart(spans, base)
        if not spans:
            return []
        scores = self.scores(text, spans)
        chosen: list[Span] = []
        starts: list[int] = []  # of the chosen spans, which lie apart, with their ends
        ends: list[int] = []
        for i in np.argsort(-scores, kind="stable"):
            kind, a, b = spans[i]
            at = bisect.bisect_left(starts, b)
            if scores[i] >= self.thresholds.get(kind, np.inf) and not (at and ends[at - 1] > a):
                chosen.append(spans[i])
                starts.insert(at, a)
                ends.insert(at, b)
        return chosen

    def scores(self, text: str, spans: list[Span]) -> np.ndarray:
        return np.concatenate(
            [
                self.trees.raw(np.array([features(text, s) for s in spans[i : i + RUN_SPANS]], float))
                for i in range(0, len(spans), RUN_SPANS)
            ]
        )


def right_spans(text: str) -> set[Span]:
    """Spans that count as right: what the rules accept, and addresses with a marked, written-out ``at``."""
    right = set(base_spans(text))
    if "(at)" in text or "[at]" in text:
        for m in _WRITTEN.finditer(text):
            plain = _AT.sub("@", m.group())
            if plain != m.group() and _EMAIL.fullmatch(_DOT.sub(".", plain).replace(" ", "")):
                right.add(("email", *m.span()))
    return right


def unclear(text: str, span: Span) -> bool:
    """Whether the rules accept a span by itself but not where it stands, as when a match swallows two numbers.

    Neither right nor wrong can be told from it, so calibration leaves it out.
    """
    kind, a, b = span
    return base_spans(text[a:b]) == [(kind, 0, b - a)]


def score_bin(scores: np.ndarray) -> np.ndarray:
    """Number of the histogram bin of a raw score; a bin holds the scores from its lower end on."""
    return np.clip(np.floor(scores * BINS_A_UNIT), -BIN_END, BIN_END).astype(np.int64)


def thresholds(counts: dict[str, dict[int, tuple[int, int]]]) -> dict[str, float]:
    """Per kind the lower end of the lowest bin from which on right spans keep the wanted precision.

    ``counts``: per kind and bin the right spans and all spans. A score below zero selects nothing.
    """
    found = {}
    for kind, bins in counts.items():
        right = total = 0
        for b in sorted(bins, reverse=True):
            right, total = right + bins[b][0], total + bins[b][1]
            if b >= 0 and bins[b][0] and right >= PRECISION * total:
                found[kind] = b / BINS_A_UNIT
    return found


def train(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> Selector:
    """Trees fitted on the documents of smallest id hash, about ``documents`` of them; thresholds from all others.

    The spans of every document that was not fitted on are counted by kind, score and whether they are right (``unclear``
    ones are not), and Spark adds the counts up, so thresholds rest on the whole table whatever its size.
    """
    n = docs.count()
    share = min(1.0, documents / max(n, 1))
    h = F.xxhash64("doc_id")
    bound = min(2**63 - 1, -(2**63) + int(2**64 * share))
    # a quarter of a small table, and all that the sample leaves of a large one
    fitted_on = F.col("doc_id").isNotNull() & (h <= F.lit(bound)) & (F.pmod(h, F.lit(4)) != 0)

    def examples(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, right, owner = [], [], []
        for i, text in enumerate(texts_of(batch.column(1))):
            spans = proposed(text)[:SPANS_A_DOCUMENT]
            good = right_spans(text) if spans else set()
            rows += [features(text, s) for s in spans]
            right += [int(s in good) for s in spans]
            owner += [i] * len(spans)
        hashes = batch.column(0).take(pa.array(owner, pa.int64()))
        x = pa.array([list(map(float, r)) for r in rows], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([hashes, x, pa.array(right, pa.int32())], ["h", "x", "y"])

    found = (
        map_batches(docs.where(fitted_on).select(h.alias("h"), "text"), examples, "h bigint, x array<double>, y int")
        .orderBy("h", "x")
        .limit(SAMPLE_SPANS)
        .collect()
    )
    y = np.array([row.y for row in found], float)
    if not len(y) or y.min() == y.max():
        return Selector()
    unset = Selector(Trees().fit(np.array([row.x for row in found]), y))

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, int, int]] = Counter()
        for text in texts_of(batch.column(0)):
            if spans := proposed(text):
                good = right_spans(text)
                spans = [s for s in spans if s in good or not unclear(text, s)]
            if spans:
                bins = score_bin(unset.scores(text, spans)).tolist()
                counts.update((KINDS.index(s[0]), b, int(s in good)) for s, b in zip(spans, bins))
        rows = [(*key, n) for key, n in counts.items()]
        names = ["kind", "bin", "is_right", "spans"]
        columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(columns, names)

    others = docs.where(~fitted_on | F.col("doc_id").isNull()).select("text")
    schema = "kind bigint, bin bigint, is_right bigint, spans bigint"
    added = map_batches(others, measure, schema).groupBy("kind", "bin").agg(
        F.sum(F.col("spans") * F.col("is_right")).alias("good"), F.sum("spans").alias("all")
    )
    counts: dict[str, dict[int, tuple[int, int]]] = {}
    for row in added.collect():  # kinds x bins rows at most
        counts.setdefault(KINDS[row.kind], {})[row.bin] = (row.good, row.all)
    return Selector(unset.trees, thresholds(counts))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find(docs: DataFrame, selector: Selector) -> DataFrame:
    """``doc_id``, rule counts per kind, the digest of the rules' spans, and all spans."""

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
        digests, spans = [], []
        for text in texts_of(batch.column(1)):
            base = base_spans(text)
            for kind, into in counts.items():
                into.append(sum(s[0] == kind for s in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(base + selector.added(text, base)))
        columns = [batch.column(0), *[pa.array(c, pa.int64()) for c in counts.values()]]
        columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        names = ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base_sha256 string, spans string"
    return map_batches(docs.select("doc_id", "text"), scan, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, selector: Selector) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; a column ``n_chars`` is brought up to date."""
    names = docs.columns

    def mask(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = dict(zip(names, batch.columns))
        texts = columns["text"].to_pylist()
        changed = False
        for i, text in enumerate(texts):
            if text and (base := base_spans(text)) + (more := selector.added(text, base)):
                texts[i], changed = redacted(text, base + more), True
        if changed:
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                known = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array(
                    [n if n is None or t is None else len(t) for n, t in zip(known, texts)], columns["n_chars"].type
                )
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return map_batches(docs, mask, docs.schema)
