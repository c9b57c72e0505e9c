"""Codes of vectors: codebooks of integer parts, nearest entries by Orchard's search.

Components become integers, ``floor(4096 * x)``, and vectors are cut into parts. The codebook of a part starts as that
part of the rows of smallest id and is moved by rounds: every part goes to its nearest entry, every entry to the
floor of the mean of its parts.

The nearest entry is found by Orchard's search: each entry has the list of all others sorted by distance. A part starts
at one entry and walks its list; where an entry is closer (or as close, with a smaller index), the walk goes on in the
list of that one. Visited entries are marked and measured once, and the walk stops at an entry farther from the current
one than twice the part's distance: by the triangle inequality that entry and all behind it are strictly farther from the
part. The parts of a batch walk side by side. All distances are integers, so results are exact in any partitioning.

A round is one pass over the stored integers: tasks return sums and counts by entry, which Spark adds up; only the
codebooks (entries x width numbers) pass through the driver.

Defined results: rows whose vector is null, or holds null or non-finite components, are dropped, and so are those of
another width than most (ties: the smaller width) and empty vectors; repeated rows and rows of one id are all kept, in
the order of id (null last), then vector; widths that ``parts`` does not divide give the first parts one component more;
with fewer rows than ``entries`` codebooks are as small; null labels count as equal; other columns of any name are not
looked at; an empty table gives an empty result and empty codebooks. Components from 2**51 on are an error, as is an
error sum beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lotseries.sources.stored import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Rows of a batch whose parts walk side by side.
RUN_ROWS = 4096


@dataclass
class Codebook:
    """Entries of one part, their distances, and for each the others from near to far."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        gap = self.entries[:, None] - self.entries[None]
        self.apart = (gap * gap).sum(axis=2)
        # By distance, then index; an entry stands in its own list, at distance 0, and is visited at once.
        self.lists = np.stack([np.array(sorted(range(len(row)), key=row.__getitem__)) for row in self.apart])

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the smallest) and the squared distance for every row."""
        n, k = len(values), len(self.entries)
        rows = np.arange(n)
        now = np.zeros(n, np.int64)
        best = self._distance(values, now)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        while len(rows):
            here = now[rows]
            other = self.lists[here, place[rows]]
            # Squared: farther than twice the distance is more than four times its square.
            stop = self.apart[here, other] > 4 * best[rows]
            new = ~stop & ~seen[rows, other]
            asked, entry = rows[new], other[new]
            seen[asked, entry] = True
            found = self._distance(values[asked], entry)
            closer = (found < best[asked]) | ((found == best[asked]) & (entry < now[asked]))
            place[rows] += 1
            moved = asked[closer]
            now[moved], best[moved], place[moved] = entry[closer], found[closer], 0
            rows = rows[~stop & (place[rows] < k)]
        return now, best

    def _distance(self, values: np.ndarray, entry: np.ndarray) -> np.ndarray:
        gap = values - self.entries[entry]
        return (gap * gap).sum(axis=1)


def _kind(*arrays: np.ndarray) -> type:
    """Numbers in which squared distances of these integers can't overflow: of 64 bits, else Python's."""
    largest = max((abs(int(end)) for a in arrays if a.size for end in (a.min(), a.max())), default=0)
    return np.int64 if 16 * arrays[0].shape[1] * largest**2 < 2**63 else object


def _by_part(values: np.ndarray, books: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part: that part of the rows, their nearest entries and the squared distances."""
    first = 0
    for entries in books:
        part = values[:, first : first + entries.shape[1]]
        first += entries.shape[1]
        kind = _kind(entries, part)
        yield part, *Codebook(entries.astype(kind)).nearest(part.astype(kind))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, RUN_ROWS):
            yield batch.slice(first, RUN_ROWS)


def integer_vectors(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, v`` of the rows that are kept, stored: every round reads them."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    large = F.raise_error(F.lit("a component is too large for an integer of 64 bits")).cast("bigint")
    whole = lambda x: F.when(F.abs(x) < 2.0**51, F.floor(x * SCALE)).otherwise(large)
    good = df.select(F.col(f"`{ident}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), v.alias("v")).where(
        (F.size("v") > 0) & ~F.exists("v", bad)
    )
    width = good.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    kept = good.where(F.size("v") == (width[0].w if width else 0))
    return stored(kept.withColumn("v", F.transform("v", whole)))


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part (entries x components) for the rows of ``integer_vectors``."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    if not first:
        return []
    books = np.array_split(np.array([row.v for row in first], np.int64), parts, axis=1)
    for _ in range(rounds):
        moved = _moved(vectors, books)
        if all(np.array_equal(a, b) for a, b in zip(books, moved)):
            break  # all further rounds would give the same
        books = moved
    return books


def _moved(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry at the floor of the mean of the parts nearest to it; unused ones stay."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        # Halves of the numbers, so that sums over a task fit 64 bits.
        high, low = ([np.zeros(b.shape, np.int64) for b in books] for _ in range(2))
        for batch in _runs(batches):
            for p, (part, nearest, _) in enumerate(_by_part(_matrix(batch.column(0)), books)):
                for e in np.unique(nearest).tolist():
                    own = part[nearest == e]
                    counts[p][e] += len(own)
                    high[p][e] += (own >> 31).sum(axis=0)
                    low[p][e] += (own & (2**31 - 1)).sum(axis=0)
        rows = [
            (p, e, i, int(counts[p][e]), Decimal((int(high[p][e, i]) << 31) + int(low[p][e, i])))
            for p in range(len(books))
            for e in np.flatnonzero(counts[p]).tolist()
            for i in range(books[p].shape[1])
        ]
        if rows:
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "place", "n", "total"])

    sums = vectors.select("v").mapInArrow(totals, "part int, entry int, place int, n bigint, total decimal(38,0)")
    added = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    moved = [b.copy() for b in books]
    for row in added.collect():  # entries x width rows, whatever the size of the table
        moved[row.part][row.entry, row.place] = int(row.total) // row.n
    return moved


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits a part, and the squared distances summed over parts."""
    kept = vectors.schema
    fields = [StructField(n, kept[n].dataType) for n in ("vec_id", "label")]
    schema = StructType([*fields, StructField("code", StringType()), StructField("error", LongType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches):
            found = list(_by_part(_matrix(batch.column("v")), books))
            codes = [bytes(row).hex() for row in np.stack([n for _, n, _ in found], axis=1).astype(np.uint8)]
            errors = [sum(map(int, row)) for row in zip(*[d.tolist() for _, _, d in found])]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return vectors.mapInArrow(coded, schema)


def label_errors(coded: DataFrame) -> DataFrame:
    """Rows of ``encode`` with ``label_error``, the errors summed over equal labels (nulls are equal)."""
    coded = stored(coded)
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def numbers(books: list[np.ndarray]) -> str:
    """All components by part, entry and place within the part."""
    return ",".join(str(x) for book in books for x in book.flat)
