"""Repeatable samples: the rows or groups with the smallest keyed hash.

The hash depends on the values only, so the sample is the same for any
partitioning, after a lost executor, and in any engine that has MD5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.sources.stored import stored

KEY = "_sample_key"
# Tasks that merge the smallest rows of all tasks.
MERGERS = 32


def sample_key(seed: int, columns: Sequence[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _smallest(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``n`` rows of smallest key of a task; it never holds more than some 2 n rows and a batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bound = None, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if bound is not None:
                rows = rows.filter(pc.less(rows[KEY], bound))
            if rows.num_rows:
                held = rows if held is None else pa.concat_tables([held, rows])
            if held is not None and held.num_rows >= 2 * max(n, 1):
                held = held.sort_by(KEY).slice(0, n)
                bound = held[KEY][-1] if n else b""
        if held is not None:
            yield from held.sort_by(KEY).slice(0, n).combine_chunks().to_batches()

    return over


def sample_rows(
    df: DataFrame, n: int, seed: int = 42, columns: Sequence[str] | None = None
) -> DataFrame:
    """At most ``n`` rows: those of smallest keyed hash.

    One pass: every task keeps its ``n`` smallest, ``MERGERS`` tasks merge those by the same rule, and the last step
    sorts what is left of at most ``n`` rows each. Of rows with equal keys any may be taken.
    """
    keyed = df.withColumn(KEY, sample_key(seed, columns or df.columns))
    least = keyed.mapInArrow(_smallest(n), keyed.schema)
    merged = least.repartition(MERGERS, KEY).mapInArrow(_smallest(n), keyed.schema)
    return merged.orderBy(KEY).limit(n).drop(KEY)


def sample_groups(
    df: DataFrame, n: int, seed: int = 42, columns: Sequence[str] | None = None
) -> DataFrame:
    """Exactly ``n`` rows of a table of groups; the query fails if there are fewer."""
    chosen = stored(sample_rows(df, n, seed, columns))
    size = chosen.agg(F.count("*").alias("size")).scalar()
    message = F.concat(F.lit(f"cannot take {n} groups out of "), size.cast("string"))
    return chosen.where(F.when(size < n, F.raise_error(message).cast("boolean")).otherwise(True))
