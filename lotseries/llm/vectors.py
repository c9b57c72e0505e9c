"""Vectors in blocks: what the two searches share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Vectors that share the queries sent to them.
ROWS_A_SHARE = 65_536

BLOCK_SCHEMA = "part int, block bigint, norm double, ids binary, data binary"


def finite_vectors(df: DataFrame, ident: str, vector: str) -> DataFrame:
    """One ``(vec_id, v)`` per id with a usable vector of the table's most frequent width."""
    v = F.col(f"`{vector}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    good = df.select(
        F.col(f"`{ident}`").cast("bigint").alias("vec_id"), v.cast("array<double>").alias("v")
    ).where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad))
    width = good.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    return good.where(F.size("v") == (width[0].w if width else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def norm_of(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def blocks_of(vectors: DataFrame, by: list[Column], size: int) -> DataFrame:
    """``BLOCK_SCHEMA`` rows: at most ``size`` vectors of one part and neighbouring sort keys.

    ``vectors`` has ``part, vec_id, v``.
    """

    def made(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(rows["v"].to_numpy()).astype("<f8")
        ids = rows["vec_id"].to_numpy("<i8")
        return pd.DataFrame(
            {
                "part": rows["part"].to_numpy()[:1],
                "block": ids[:1],
                "norm": [np.sqrt((values * values).sum(axis=1).max())],
                "ids": [ids.tobytes()],
                "data": [values.tobytes()],
            }
        )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held):
                same = int((held["part"] != held["part"].iloc[0]).argmax()) or len(held)
                if same == len(held) and same < size:
                    break  # more of this part may follow
                yield made(held[: min(same, size)])
                held = held[min(same, size) :].reset_index(drop=True)
        if held is not None and len(held):
            yield made(held)

    # The id breaks ties, so equal keys never have to share a partition.
    keys = [F.col("part"), *by, F.col("vec_id")]
    ranged = vectors.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ranged.select("part", "vec_id", "v").mapInPandas(cut, BLOCK_SCHEMA)


def unpack(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, "<i8")
    return found, np.frombuffer(data, "<f8").reshape(len(found), -1)


def meet(query_blocks: DataFrame, vector_blocks: DataFrame, tasks: int = 1) -> DataFrame:
    """Every block of queries with every block of vectors of its part, largest norms first.

    The blocks of a part are dealt to shares, so a part that holds many rows is searched by many
    tasks, by ``tasks`` at least if it has as many blocks; queries go to each share of their part.
    """
    sizes = vector_blocks.groupBy("part").agg(
        F.count("*").alias("blocks"), (F.sum(F.octet_length("ids")) / (8 * ROWS_A_SHARE)).alias("full")
    )
    shares = sizes.select(
        "part", F.greatest(F.ceil("full"), F.least("blocks", F.lit(tasks))).cast("int").alias("shares")
    )
    left = vector_blocks.join(shares, "part").withColumn(
        "share", F.pmod(F.xxhash64("block"), F.col("shares")).cast("int")
    )
    right = (
        query_blocks.select(
            "part",
            F.col("block").alias("q_block"),
            F.col("ids").alias("q_ids"),
            F.col("data").alias("q_data"),
            *[c for c in query_blocks.columns if c not in BLOCK_SCHEMA.replace(",", "").split()],
        )
        .join(shares, "part")
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    )
    # Shuffled even if small: then a query meets all blocks of a share in one task and leaves its best there once.
    pairs = right.drop("shares").join(left.drop("shares", "block").hint("merge"), ["part", "share"])
    return pairs.sortWithinPartitions("part", "share", "q_block", F.desc("norm"))


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def best_of_lists(found: DataFrame, k: int) -> DataFrame:
    """``best_of`` for rows that hold a list of a query's best: ``query_id, ids, scores``."""
    pairs = F.transform(
        F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("worse"), x["ids"].alias("vec_id"))
    )
    lists = found.select("query_id", pairs.alias("best")).groupBy("query_id")
    merged = lists.agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return merged.select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), "b.vec_id", (-F.col("b.worse")).alias("score")
    )
