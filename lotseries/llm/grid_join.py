"""Near-duplicate vectors by an epsilon grid order join.

Two vectors link when their cosine reaches the threshold, which is when their unit vectors lie within ``eps`` of each
other. Unit vectors are turned onto principal dimensions; the leading ones give grid cells of side ``eps``, and the table
is sorted by those cells. Blocks of the sorted sequence carry the box of their leading coordinates. Sequence intervals are
joined recursively: a pair of intervals whose boxes are farther apart than ``eps`` is skipped with all below it, others
are split. Spark does so down to pairs of blocks, level by level with equi-joins on the parent interval; a task goes on
within its pair of blocks down to ``LEAF`` rows, whose products are taken at once. A turn only changes what is skipped, so
the result is exact; the dimensions are fitted on ``SAMPLE`` vectors (those of smallest hash).

Equal vectors are one class before anything is compared. A pair of blocks gives no links but, for each row that has
any, how many it has and a smallest row it hangs together with, so a group of any size leaves as many rows as it has
members per pair of blocks. Components come from those.

Defined results: vectors that are null, empty, zero, of another width than most (ties: the smaller), or hold null or
non-finite components link with nothing: no links, a component of their own, kept. Repeated rows and rows of one id are
vectors of their own. A null id never names a component unless all members have none; it is kept only in such a one. An
empty table gives an empty result. Other columns of any name are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotseries.sources.stored import release, stored

from .shingles import components

COSINE = 0.95
# Vectors that the principal dimensions are fitted on, and how many of these order the table.
SAMPLE = 4096
LEAD = 8
# Rows of a block and bytes of its vectors at most; rows whose products are taken at once.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4_000_000
LEAF = 256
# Rows that one task cuts into blocks, about.
ROWS_A_TASK = 65_536
# Intervals of one level that make one of the next, as a power of two.
FAN_BITS = 4
# Products this close to the threshold are taken again from the vectors as they are.
CLOSE = 1e-9
# Rows of one task are numbered below this power of two.
ROW_BITS = 40


def unit_vectors(values: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal(values: np.ndarray, lead: int = LEAD) -> np.ndarray:
    """The directions of largest variance of unit vectors, as columns."""
    spread = values - values.mean(axis=0)
    return np.linalg.eigh(spread.T @ spread)[1][:, ::-1][:, :lead]


def _reach(cosine: float) -> float:
    """Distance of unit vectors within which they may link, with room for rounding."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-7)


class Block:
    """Rows next to each other in the sequence, and the boxes of their halves, quarters and so on."""

    def __init__(self, first: int, copies: bytes, data: bytes, kind: str, turn: np.ndarray) -> None:
        self.copies = np.frombuffer(copies, "<i8")
        self.n = len(self.copies)
        self.values = np.frombuffer(data, kind).reshape(self.n, -1).astype(float)
        self.units = unit_vectors(self.values)
        self.nodes = first + np.arange(self.n)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self._box(0, self.n, self.units @ turn)

    def _box(self, i: int, j: int, lead: np.ndarray) -> None:
        self.boxes[i, j] = lead[i:j].min(axis=0), lead[i:j].max(axis=0)
        if j - i > LEAF:
            for half in self.halves(i, j):
                self._box(*half, lead)

    @staticmethod
    def halves(i: int, j: int) -> tuple[tuple[int, int], tuple[int, int]]:
        middle = (i + j) // 2
        return (i, middle), (middle, j)


class Links:
    """Links between the rows of two blocks, or within one (``a is b``)."""

    def __init__(self, a: Block, b: Block, cosine: float) -> None:
        self.a, self.b, self.cosine = a, b, cosine
        self.reach = _reach(cosine) ** 2
        self.shift = 0 if a is b else a.n
        self.counts = np.zeros(self.shift + b.n, np.int64)
        self.root = np.arange(self.shift + b.n)
        self._join((0, a.n), (0, b.n))

    def _join(self, s: tuple[int, int], t: tuple[int, int]) -> None:
        if self.a is self.b and t[1] <= s[0]:
            return  # met the other way round
        (low, high), (low_t, high_t) = self.a.boxes[s], self.b.boxes[t]
        gap = np.maximum(0, np.maximum(low_t - high, low - high_t))
        if gap @ gap > self.reach:
            return
        parts_s = Block.halves(*s) if s[1] - s[0] > LEAF else [s]
        parts_t = Block.halves(*t) if t[1] - t[0] > LEAF else [t]
        if len(parts_s) == len(parts_t) == 1:
            self._leaf(slice(*s), slice(*t))
            return
        for x in parts_s:
            for y in parts_t:
                self._join(x, y)

    def _leaf(self, s: slice, t: slice) -> None:
        a, b = self.a, self.b
        products = a.units[s] @ b.units[t].T
        linked = products >= self.cosine
        for i, j in np.argwhere(np.abs(products - self.cosine) < CLOSE):
            x, y = a.values[s][i], b.values[t][j]
            linked[i, j] = (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= self.cosine
        same = a is b and s == t
        if same:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        rows, columns = np.arange(s.start, s.stop), self.shift + np.arange(t.start, t.stop)
        self.counts[rows] += linked @ b.copies[t]
        if not same:
            self.counts[columns] += a.copies[s] @ linked
        self._hang(linked, rows, columns)

    def _hang(self, linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        """Give linked rows one root, the smallest of theirs."""
        most = len(self.root)
        while True:
            x, y = self.root[rows], self.root[columns]
            least_x = np.minimum(x, np.where(linked, y[None], most).min(axis=1))
            least_y = np.minimum(y, np.where(linked, x[:, None], most).min(axis=0))
            if (least_x == x).all() and (least_y == y).all():
                return
            np.minimum.at(self.root, x, least_x)
            np.minimum.at(self.root, y, least_y)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]

    def rows(self) -> pa.RecordBatch:
        nodes = self.b.nodes if self.a is self.b else np.concatenate([self.a.nodes, self.b.nodes])
        some = np.flatnonzero(self.counts)
        columns = [nodes[some], self.counts[some], nodes[self.root[some]]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "root"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(ends, np.ascontiguousarray(matrix).ravel())


def _blocks(classes: DataFrame, turn: np.ndarray, reach: float) -> DataFrame:
    """Blocks of the classes in the order of their cells: ``task, place, first, copies, ids, data, low, high``."""
    vector = classes.schema["v"].dataType.simpleString()
    kind = "<f4" if "float" in vector else "<f8"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lead = unit_vectors(_matrix(batch.column("v")).astype(float)) @ turn
                # A hot cell goes on by its coordinates, so equal cells never have to share a partition.
                keys = [_lists(np.floor(lead / reach).astype(np.int32)), _lists(lead)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(["v", "copies", "least"]).columns, *keys], ["v", "copies", "least", "cell", "lead"]
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held, place, first = None, 0, task << ROW_BITS
        most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (len(turn) * int(kind[-1]))))

        def made(rows: pa.Table) -> pa.RecordBatch:
            lead = _matrix(rows.column("lead").combine_chunks())
            ids = rows.column("least")
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "task": task,
                        "place": place,
                        "first": first,
                        "copies": rows.column("copies").to_numpy().astype("<i8").tobytes(),
                        "ids": ids.to_pylist(),
                        "data": _matrix(rows.column("v").combine_chunks()).astype(kind).tobytes(),
                        "low": lead.min(axis=0).tolist(),
                        "high": lead.max(axis=0).tolist(),
                    }
                ],
                schema=pa.schema(
                    [("task", pa.int32()), ("place", pa.int32()), ("first", pa.int64()), ("copies", pa.binary())]
                    + [("ids", pa.list_(pa.int64())), ("data", pa.binary())]
                    + [(end, pa.list_(pa.float64())) for end in ("low", "high")]
                ),
            )

        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            while held.num_rows >= most:
                yield made(held.slice(0, most))
                held, place, first = held.slice(most), place + 1, first + most
        if held is not None and held.num_rows:
            yield made(held)

    keyed = classes.mapInArrow(placed, f"v {vector}, copies bigint, least bigint, cell array<int>, lead array<double>")
    # Many small partitions would make as many small blocks, and a pair of blocks costs the same however small.
    tasks = -(-classes.count() // ROWS_A_TASK)
    ranged = keyed.repartitionByRange("cell", "lead").sortWithinPartitions("cell", "lead").coalesce(max(tasks, 1))
    return ranged.select("v", "copies", "least", "lead").mapInArrow(
        cut,
        "task int, place int, first bigint, copies binary, ids array<bigint>, data binary, "
        "low array<double>, high array<double>",
    )


def _near(x: str, y: str, dims: int, reach: float) -> Column:
    """Whether the boxes of two intervals come within reach of each other."""
    zero, square = F.lit(0.0), F.lit(0.0)
    for i in range(dims):
        gap = F.greatest(
            F.col(f"{y}.low{i}") - F.col(f"{x}.high{i}"), F.col(f"{x}.low{i}") - F.col(f"{y}.high{i}"), zero
        )
        square = square + gap * gap
    return square <= reach**2


def _block_pairs(blocks: DataFrame, dims: int, reach: float) -> DataFrame:
    """``a, b`` of the blocks (``seq``, in the order of the sequence, ``a <= b``) that may hold links."""
    ends = [F.col("low")[i].alias(f"low{i}") for i in range(dims)] + [F.col("high")[i].alias(f"high{i}") for i in range(dims)]
    boxes = blocks.select("seq", *ends)
    last = boxes.agg(F.max("seq")).first()[0]
    if last is None:
        return boxes.select(F.col("seq").alias("a"), F.col("seq").alias("b"))
    levels = -(-int(last).bit_length() // FAN_BITS)
    # the whole sequence with itself; no constants, which would drop out of the join keys
    pairs = blocks.sparkSession.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    for level in reversed(range(levels + 1) if not levels else range(levels)):
        shift = FAN_BITS * level
        spans = [f(f"{end}{i}").alias(f"{end}{i}") for end, f in (("low", F.min), ("high", F.max)) for i in range(dims)]
        own = boxes.groupBy(F.shiftright("seq", shift).alias("seq")).agg(*spans) if level else boxes
        own = own.withColumn("above", F.shiftright("seq", FAN_BITS))
        pairs = (
            pairs.join(own.alias("x"), F.col("a") == F.col("x.above"))
            .join(own.alias("y"), (F.col("b") == F.col("y.above")) & (F.col("x.seq") <= F.col("y.seq")) & _near("x", "y", dims, reach))
            .select(F.col("x.seq").alias("a"), F.col("y.seq").alias("b"))
        )
    return pairs


def near_vectors(
    df: DataFrame, cosine: float = COSINE, ident: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``."""
    v = F.col("v")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = df.select(F.col(f"`{ident}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    finite = (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    width = rows.where(finite).groupBy(F.size(v).alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    good = F.coalesce(finite & (F.size(v) == (width[0].w if width else 0)), F.lit(False))

    classes = stored(rows.where(good).groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least")))
    sample = classes.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()
    turn = principal(unit_vectors(np.array([row.v for row in sample], float))) if sample else np.zeros((0, 0))
    reach = _reach(cosine)
    blocks = stored(_blocks(classes, turn, reach))
    places = blocks.agg(F.max("place")).first()[0] or 0
    blocks = blocks.withColumn("seq", F.shiftleft(F.col("task").cast("bigint"), int(places).bit_length()) + F.col("place"))

    kind = "<f4" if "float" in classes.schema["v"].dataType.simpleString() else "<f8"
    found = stored(_compared(blocks, _block_pairs(blocks, turn.shape[1], reach), kind, turn, cosine))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))

    narrow = _members(blocks).join(links, "node", "left").join(labels, "node", "left")
    narrow = stored(narrow.withColumn("component", F.coalesce("component", "node")))
    release(classes, found)
    least = narrow.groupBy("component").agg(F.min("least").alias("component_id"))
    results = narrow.join(least, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    vectors = _vectors(blocks, classes.schema["v"].dataType.simpleString(), kind)
    named = rows.where(good).join(vectors, "v").select("vec_id", "node")
    linked = named.join(results, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _compared(blocks: DataFrame, pairs: DataFrame, kind: str, turn: np.ndarray, cosine: float) -> DataFrame:
    """``node, links, root`` of the rows with links, for each pair of blocks."""
    whole = lambda end: blocks.select(
        F.col("seq").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("first", "copies", "data")]
    )
    both = pairs.join(whole("a"), "a").join(whole("b"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, Block]] = {}

        def block(row: dict, end: str) -> Block:
            for seq, known in held.values():
                if seq == row[end]:
                    return known
            return Block(row[f"{end}_first"], row[f"{end}_copies"], row[f"{end}_data"], kind, turn)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for end in ("b", "a"):  # rows come by b, so its block serves many
                    held[end] = row[end], block(row, end)
                found = Links(held["a"][1], held["b"][1], cosine).rows()
                if found.num_rows:
                    yield found

    return both.mapInArrow(compare, "node bigint, links bigint, root bigint")


def _members(blocks: DataFrame) -> DataFrame:
    """``node, copies, least`` of every class."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                copies = np.frombuffer(row["copies"], "<i8")
                columns = [pa.array(row["first"] + np.arange(len(copies))), pa.array(copies), pa.array(row["ids"], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "copies", "least"])

    return blocks.select("first", "copies", "ids").mapInArrow(unpack, "node bigint, copies bigint, least bigint")


def _vectors(blocks: DataFrame, vector: str, kind: str) -> DataFrame:
    """``node, v`` of every class."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["copies"]) // 8
                values = np.frombuffer(row["data"], kind).reshape(n, -1)
                yield pa.RecordBatch.from_arrays([pa.array(row["first"] + np.arange(n)), _lists(values)], ["node", "v"])

    return blocks.select("first", "copies", "data").mapInArrow(unpack, f"node bigint, v {vector}")
