"""Word shingles as 64-bit hashes, and connected components of links."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotseries.sources.stored import release, stored

WIDTH = 5

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words: A-Z lower-cased, parted by ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the ``WIDTH`` words from each place on; fewer words make one shingle, none make none."""
    n = min(len(words), WIDTH)
    if not n:
        return words
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total += words[i : len(words) - n + 1 + i] * _FACTORS[i]
    return mixed(total)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for the nodes of ``links`` (``a, b``).

    Alternating large and small stars: every node hands its smallest neighbour to the others, until
    nothing changes. Rounds grow with the logarithm of the longest path; a hub is only ever aggregated
    and joined, never gathered.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            lower = joined.where(F.col("b") < F.col("a"))
            moved = lower.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                lower.select("a", F.col("m").alias("b"))
            )
        return moved.where(F.col("a") != F.col("b")).distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(links.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    before = state(edges)
    while before[0]:
        after = stored(star(star(edges, True), False))
        release(edges)
        edges, now = after, state(after)
        if now == before:
            break
        before = now
    # Now every edge leads from a node to the smallest of its component.
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
