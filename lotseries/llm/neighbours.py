"""Approximate nearest neighbours by learned partitions.

On a bounded sample: a neighbour graph, a balanced partitioning of that graph (capacity-bounded
label moves that raise the number of neighbours within a part), and a small classifier from a
vector to the parts of its neighbours. Every row is indexed in the part the classifier holds most
probable; a query goes to its most probable parts, as many as the sample needs for the wanted
recall, and all vectors there are ranked by their exact inner product.

Defined results: vectors that are null, empty, zero, of another width than most, or hold null or
non-finite components take no part, nor do rows without id; of several vectors with one id the
smallest in array order counts, so repeated rows count once; ties go to the smaller id; with fewer
than k candidates found all are returned (a table of at most ``PARTS * k`` rows is one part);
an empty table gives an empty result. Other columns of any name are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.sources.stored import stored

from .vectors import best_of_lists, blocks_of, finite_vectors, meet, norm_of, unpack

# Bound of the sample the index is fitted on.
SAMPLE = 8_000
PARTS = 16
GRAPH_DEGREE = 12
HIDDEN = 96
# Recall wanted on the sample; the whole table is denser, so its recall is higher.
SAMPLE_RECALL = 0.95
BLOCK = 4096
QUERY_BLOCK = 512


def _nearest(queries: np.ndarray, own: np.ndarray, base: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest products per query, leaving out place ``own`` of the query."""
    rows = []
    for first in range(0, len(queries), 500):
        scores = queries[first : first + 500] @ base.T
        scores[np.arange(len(scores)), own[first : first + 500]] = -np.inf
        rows.append(np.argpartition(-scores, k - 1, axis=1)[:, :k])
    return np.concatenate(rows)


def balanced_parts(graph: np.ndarray, seeds: np.ndarray, parts: int, sweeps: int = 12) -> np.ndarray:
    """Labels of the nodes: parts of nearly equal size with many edges inside.

    Starts from the order along ``seeds`` (recursive halves by leading directions) and moves nodes to
    the part most of their neighbours are in, best gain first, while parts have room.
    """
    n = len(graph)
    label = np.zeros(n, np.int64)
    groups = [np.arange(n)]
    while len(groups) < parts:
        halves = []
        for group in groups:
            spread = seeds[group] - seeds[group].mean(axis=0)
            axis = np.linalg.svd(spread.T @ spread)[0][:, 0]
            order = group[np.argsort(spread @ axis, kind="stable")]
            halves += [order[: len(order) // 2], order[len(order) // 2 :]]
        groups = halves
    for i, group in enumerate(groups):
        label[group] = i
    parts = len(groups)
    room = int(np.ceil(1.1 * n / parts))
    # Both directions of every edge count.
    a = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    b = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(sweeps):
        votes = np.bincount(a * parts + label[b], minlength=n * parts).reshape(n, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if moved < n // 500:
            break
    return label


class Router:
    """One hidden layer; probabilities of the parts for each vector."""

    def __init__(self, width: int, parts: int, scale: float, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        self.scale = scale
        self.w = [
            r.normal(0, np.sqrt(2 / width), (width, HIDDEN)),
            np.zeros(HIDDEN),
            r.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)),
            np.zeros(parts),
        ]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w[0] + self.w[1], 0)
        z = h @ self.w[2] + self.w[3]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return h, z / z.sum(axis=1, keepdims=True)

    def probabilities(self, v: np.ndarray) -> np.ndarray:
        return self._forward(v * self.scale)[1]

    def fit(self, v: np.ndarray, target: np.ndarray, epochs: int = 40, seed: int = 11) -> None:
        """Cross-entropy against soft targets, by Adam."""
        x = v * self.scale
        r = np.random.default_rng(seed)
        m, s, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for first in range(0, len(x), 256):
                i = order[first : first + 256]
                h, p = self._forward(x[i])
                dz = (p - target[i]) / len(i)
                dh = dz @ self.w[2].T * (h > 0)
                grads = [x[i].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)]
                t += 1
                for j, g in enumerate(grads):
                    m[j] = 0.9 * m[j] + 0.1 * g
                    s[j] = 0.999 * s[j] + 0.001 * g * g
                    step = m[j] / (1 - 0.9**t) / (np.sqrt(s[j] / (1 - 0.999**t)) + 1e-8)
                    self.w[j] = self.w[j] - 2e-3 * step


def fit_index(sample: np.ndarray, k: int, parts: int = PARTS, recall: float = SAMPLE_RECALL) -> tuple[Router, int]:
    """The router, and the number of parts a query has to be sent to."""
    n = len(sample)
    everyone = np.arange(n)
    graph = _nearest(sample, everyone, sample, GRAPH_DEGREE)
    label = balanced_parts(graph, sample, parts)
    parts = int(label.max()) + 1
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(everyone, GRAPH_DEGREE), label[graph].ravel()), 1 / GRAPH_DEGREE)
    target = 0.5 * target + 0.5 * np.eye(parts)[label]
    held = everyone % 10 == 0  # these only measure
    router = Router(sample.shape[1], parts, 1 / max(np.sqrt((sample * sample).mean()), 1e-12))
    router.fit(sample[~held], target[~held])
    chances = router.probabilities(sample)
    home = chances.argmax(axis=1)
    asked = np.flatnonzero(held)
    near = _nearest(sample[asked], asked, sample, k)
    place = np.argsort(np.argsort(-chances[asked], axis=1, kind="stable"), axis=1, kind="stable")
    depth = np.take_along_axis(place, home[near], axis=1)
    reached = [(depth < probes).mean() for probes in range(1, parts + 1)]
    return router, 1 + next(i for i, x in enumerate(reached) if x >= recall)


def _score(found: np.ndarray, values: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """The ``k`` best of a block for each query, scored by a running sum in component order.

    The matrix product only picks; whatever it leaves within its rounding is kept, so that equal vectors tie.
    """
    rough = queries @ values.T
    slack = 1e-12 * np.linalg.norm(queries, axis=1) * np.sqrt((values * values).sum(axis=1).max())
    rows = []
    for i, q in enumerate(q_ids.tolist()):
        scores = rough[i]
        scores[found == q] = -np.inf
        near = np.flatnonzero(scores > -np.inf)
        if len(near) > k:
            near = np.flatnonzero(scores >= np.partition(scores, -k)[-k] - slack[i])
        exact = np.cumsum(values[near] * queries[i], axis=1)[:, -1]
        order = np.lexsort((found[near], -exact))[:k]
        rows += [(q, a, b) for a, b in zip(found[near[order]].tolist(), exact[order].tolist())]
    return rows


def nearest_neighbours(
    df: DataFrame,
    queries: Column,
    k: int,
    ident: str = "vec_id",
    vector: str = "embedding",
    sample: int = SAMPLE,
    parts: int = PARTS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each id for which the condition ``queries`` holds."""
    whole = stored(finite_vectors(df, ident, vector).where(norm_of("v") > 0))
    n = whole.count()
    if n > parts * k:
        # Smallest hashes, of which a bound leaves about twice the sample.
        h = F.xxhash64("vec_id")
        bound = -(2**63) + min(2**64 - 1, int(2**64 * min(1.0, 2 * sample / n)))
        rows = whole.where(h <= F.lit(min(bound, 2**63 - 1))).orderBy(h, "vec_id").limit(sample).select("v").collect()
        router, probes = fit_index(np.array([row.v for row in rows]), k, parts)
    else:
        router, probes = None, 1

    def routed(most: int):
        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if router is None:
                    yield batch.assign(part=0)[["part", "vec_id", "v"]]
                    continue
                chances = router.probabilities(np.stack(batch["v"].to_numpy()))
                chosen = np.argsort(-chances, axis=1, kind="stable")[:, :most]
                again = batch.loc[batch.index.repeat(chosen.shape[1])]
                yield again.assign(part=chosen.ravel())[["part", "vec_id", "v"]]

        return route

    schema = "part int, vec_id bigint, v array<double>"
    vector_blocks = stored(blocks_of(whole.mapInPandas(routed(1), schema), [], BLOCK))
    asked = whole.where(queries).mapInPandas(routed(probes), schema)
    query_blocks = stored(blocks_of(asked, [], QUERY_BLOCK))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The blocks of a share follow each other, so a query leaves a task as one row with its k best there.
        best: dict[int, list[tuple[float, int]]] = {}
        of = None

        def rows() -> pd.DataFrame:
            found = [(q, [i for _, i in kept], [-s for s, _ in kept]) for q, kept in best.items()]
            return pd.DataFrame(found, columns=["query_id", "ids", "scores"])

        for batch in batches:
            for row in batch.itertuples(index=False):
                if of != (row.part, row.share, row.q_block):
                    if best:
                        yield rows()
                    best, of = {}, (row.part, row.share, row.q_block)
                found, values = unpack(row.ids, row.data)
                q_ids, q = unpack(row.q_ids, row.q_data)
                for query, i, s in _score(found, values, q_ids, q, k):
                    best.setdefault(query, []).append((-s, i))
                for query, kept in best.items():
                    if len(kept) > k:
                        best[query] = sorted(kept)[:k]
        if best:
            yield rows()

    pairs = meet(query_blocks, vector_blocks).select("part", "share", "q_block", "q_ids", "q_data", "ids", "data")
    return best_of_lists(pairs.mapInPandas(search, "query_id bigint, ids array<bigint>, scores array<double>"), k)
