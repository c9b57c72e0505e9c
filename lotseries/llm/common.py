"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts of a batch handed to Python are cut into runs of about this many characters, so that
# what a task holds beside the batch does not depend on the length of the texts.
RUN_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def give_back() -> None:
    """Return free memory to the system at the end of a task: Python workers outlive their tasks, and their heaps
    would else stay as large as the largest task made them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``function`` over the Arrow batches of every partition, in runs of bounded text."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                yield from function(run)
        give_back()

    return df.mapInArrow(over, schema)


def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if not batch.num_rows:
        return
    parts = max(1, min(batch.num_rows, -(-batch.nbytes // RUN_CHARS)))
    step = -(-batch.num_rows // parts)
    for first in range(0, batch.num_rows, step):
        yield batch.slice(first, step)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null counts as empty."""
    return [text or "" for text in column.to_pylist()]
