"""Exact top-k by inner product: norm-sorted blocks, rotated partial sums, residual bounds.

Vectors become integers, ``floor(256 * x)``, and are dealt by descending norm into blocks. All are
rotated by the singular vectors of the table, so that the first coordinates carry most of a
product. For a query with a known lower bound of its k-th best score

* a block is skipped if ``|q| * (largest norm of the block)`` lies below the bound, and
* a vector is dropped if ``partial product + |q rest| * |v rest|`` does, by Cauchy-Schwarz.

What is left gets its exact integer product. First bounds come from the vectors of largest norm;
they rise from block to block.

Defined results: vectors that are null, empty, of another width than most, or hold null or
non-finite components take no part, nor do rows without id; of several vectors with one id the
smallest in array order counts, so repeated rows count once; ties go to the smaller id; with fewer
than k candidates all are returned; an empty table gives an empty result. Scores are exact whatever
their size; components from 2**55 on, and scores beyond 64 bits, are an error. Other columns of any
name are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.sources.stored import stored

from .vectors import BLOCK_SCHEMA, best_of, blocks_of, finite_vectors, meet, norm_of, unpack

# Vectors in a block and queries in a block: their products are held at once.
BLOCK = 4096
QUERY_BLOCK = 512
# Vectors of largest norm that give the first bounds.
FIRST = 1024
# Coordinates in the partial sums.
HEAD = 16
# Rounding of products of doubles, relative to the norms; the scores themselves are exact.
SLACK = 1e-9
# Products of norms below which doubles hold every partial sum; beyond, Python's integers do.
EXACT = 2.0**52


def rotation(vectors: DataFrame) -> np.ndarray:
    """Right singular vectors of the whole table, from its width x width sum of products."""

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                v = np.stack(batch["v"].to_numpy())
                total = v.T @ v if total is None else total + v.T @ v
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "row": list(total)})

    parts = vectors.select("v").mapInPandas(products, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    rows = cells.collect()  # width x width numbers
    width = 1 + max((row.i for row in rows), default=-1)
    gram = np.zeros((width, width))
    for row in rows:
        gram[row.i, row.j] = row.x
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1] if width else gram


def _exact(values: np.ndarray, query: np.ndarray) -> list[int]:
    """Inner products of integers of any size."""
    q = [int(x) for x in query.tolist()]
    return [sum(int(x) * y for x, y in zip(row, q)) for row in values.tolist()]


class Search:
    """The best ``k`` of each query of a block over the vectors shown so far."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, bounds: np.ndarray, turn: np.ndarray, k: int) -> None:
        self.ids, self.values, self.bounds, self.turn, self.k = ids, values, bounds.astype(float), turn, k
        self.turned = values @ turn
        self.norm = np.linalg.norm(values, axis=1)
        self.rest = np.linalg.norm(self.turned[:, HEAD:], axis=1)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]

    def show(self, ids: np.ndarray, values: np.ndarray) -> None:
        longest = np.sqrt((values * values).sum(axis=1).max())
        reach = self.norm * longest * (1 + SLACK)
        asked = np.flatnonzero(reach >= self.bounds)
        if not len(asked):
            return
        turned = values @ self.turn
        rest = np.linalg.norm(turned[:, HEAD:], axis=1)
        upper = self.turned[asked, :HEAD] @ turned[:, :HEAD].T + np.outer(self.rest[asked], rest)
        open_ = upper + SLACK * reach[asked, None] >= self.bounds[asked, None]
        for row, q in zip(open_, asked):
            near = np.flatnonzero(row & (ids != self.ids[q]))
            if not len(near):
                continue
            if reach[q] < EXACT:
                scores = values[near] @ self.values[q]  # all partial sums are integers below 2^53
                if len(near) > self.k:
                    least = np.partition(scores, -self.k)[-self.k]
                    near, scores = near[scores >= least], scores[scores >= least]
                found = list(zip((-scores).astype(np.int64).tolist(), ids[near].tolist()))
            else:
                found = list(zip((-s for s in _exact(values[near], self.values[q])), ids[near].tolist()))
            self.best[q] = sorted(self.best[q] + found)[: self.k]
            if len(self.best[q]) == self.k:
                self.bounds[q] = max(self.bounds[q], float(-self.best[q][-1][0]))

    def rows(self) -> pd.DataFrame:
        found = [(q, i, -s) for q, best in zip(self.ids.tolist(), self.best) for s, i in best]
        if any(abs(s) >= 2**63 for _, _, s in found):
            raise OverflowError("a score is too large for 64 bits")
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def exact_top_k(df: DataFrame, queries: Column, k: int, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best for each id for which ``queries`` holds.

    ``queries`` is a condition on ``vec_id``. Blocks of queries meet blocks of vectors in an
    equi-join, so the pairs are those of the stated query set against all rows.
    """
    large = F.raise_error(F.lit("a component is too large for an integer of 64 bits")).cast("double")
    whole = lambda x: F.when(F.abs(x) < 2.0**55, F.floor(x * 256).cast("double")).otherwise(large)
    scaled = finite_vectors(df, ident, vector).withColumn("v", F.transform("v", whole))
    whole = stored(scaled.select(F.lit(0).alias("part"), "vec_id", "v", norm_of("v").alias("norm")))
    turn = rotation(whole)

    top = whole.orderBy(F.desc("norm"), "vec_id").limit(FIRST).select("vec_id", "v").collect()
    top_ids = np.array([row.vec_id for row in top], np.int64)
    top_values = np.array([row.v for row in top]).reshape(len(top), len(turn))

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            low = []
            for ids, data in zip(batch["ids"], batch["data"]):
                i, q = unpack(ids, data)
                least = np.full(len(i), -np.inf)
                if len(top_ids) >= k:
                    scores = q @ top_values.T
                    scores[i[:, None] == top_ids[None]] = -np.inf
                    least = np.partition(scores, -k, axis=1)[:, -k]
                    least -= SLACK * np.linalg.norm(q, axis=1) * np.linalg.norm(top_values, axis=1).max()
                low.append(least.astype("<f8").tobytes())
            yield batch.assign(low=low)

    asked = blocks_of(whole.where(queries), [], QUERY_BLOCK)
    query_blocks = stored(asked.mapInPandas(bounded, BLOCK_SCHEMA + ", low binary"))
    vector_blocks = stored(blocks_of(whole, [F.desc("norm")], BLOCK))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, of = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if of != (row.share, row.q_block):
                    if held is not None:
                        yield held.rows()
                    held = Search(*unpack(row.q_ids, row.q_data), np.frombuffer(row.low, "<f8"), turn, k)
                    of = (row.share, row.q_block)
                held.show(*unpack(row.ids, row.data))
        if held is not None:
            yield held.rows()

    tasks = df.sparkSession.sparkContext.defaultParallelism
    pairs = meet(query_blocks, vector_blocks, tasks).select("share", "q_block", "q_ids", "q_data", "low", "ids", "data")
    return best_of(pairs.mapInPandas(search, "query_id bigint, vec_id bigint, score bigint"), k)
