"""HTML yield reports: rows, header, column names, typed columns.

A report is read in byte ranges, whatever the case of its tags, so one large file is split over many
tasks. Rows keep their place in the file by (file, start of the split, number within the split). Only the
header row comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotseries.functions.text import html_cells, html_rows, number, slug, whole_number
from lotseries.sources.stored import stored

# Non-empty cells that make a row the header.
HEADER_MIN_CELLS = 10

POSITION = ["file", "block", "line", "pos"]

# Bytes without a closing tag that are held before they are handed on as part of a row.
MOST_HELD = 1_000_000

_PIECES = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("part", pa.int32())]
    + [("closed", pa.bool_()), ("alone", pa.bool_()), ("text", pa.string())]
)


class _Range:
    """The rows of one byte range: pieces that end with a closing tag, and what lies behind the last."""

    def __init__(self, file: str, block: int) -> None:
        self.file, self.block = file, block
        self.line = self.part = self.held_bytes = 0
        self.held: list[bytes] = []

    def piece(self, closed: bool) -> tuple:
        # the first row may have begun in the range before, the last one may go on in the next
        alone = closed and self.line > 0 and self.part == 0
        text = b"".join(self.held).decode("utf-8", "replace")
        found = (self.file, self.block, self.line, self.part, closed, alone, text)
        self.held, self.held_bytes = [], 0
        self.line, self.part = (self.line + 1, 0) if closed else (self.line, self.part + 1)
        return found

    def add(self, tag: bytes) -> tuple | None:
        self.held += [tag, b">"]
        self.held_bytes += len(tag) + 1
        if tag[-4:].lower() == b"</tr":
            return self.piece(True)
        return self.piece(False) if self.held_bytes > MOST_HELD else None


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(_PIECES.names, row)) for row in found], _PIECES)

    now: _Range | None = None
    for batch in batches:
        found = []
        for tag, file, block in zip(*[column.to_pylist() for column in batch.columns]):
            if now is None or (now.file, now.block) != (file, block):
                if now is not None:
                    found.append(now.piece(False))
                now = _Range(file, block)
            piece = now.add(tag)
            if piece is not None:
                found.append(piece)
        yield made(found)
    if now is not None:
        yield made([now.piece(False)])


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """Rows that go over the border of byte ranges; what no closing tag follows is none."""
    by_place = W.partitionBy("file").orderBy("block", "line", "part")
    before = by_place.rowsBetween(W.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.col("closed").cast("int")).over(before), F.lit(0))
    numbered = pieces.where("not alone").withColumn("number", number)
    last = F.max(F.when(F.col("closed"), F.col("number"))).over(W.partitionBy("file"))
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "part", "text")))
    rows = numbered.withColumn("last", last).where("number <= last").groupBy("file", "number").agg(parts.alias("parts"))
    first = F.col("parts")[0]
    return rows.select("file", first.block.alias("block"), first.line.alias("line"), F.array_join("parts.text", "").alias("text"))


def read_report_rows(spark: SparkSession, path: str) -> DataFrame:
    """Cells of every row with any content of the reports at a path, with its position.

    The files are read tag by tag (records end with ``>``), so their byte ranges are shared out like those of any text.
    Each range is cut behind its closing row tags, of any case; only what lies before the first and behind the
    last of them, where a row may go over the border, is put together afterwards. What follows the last closing
    tag of a file is no row (a last ``>`` may be missing). Bytes that are no UTF-8 are replaced.
    """
    tags = (
        spark.read.option("lineSep", ">")
        .text(path)
        .select(
            F.col("value").cast("binary"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )
    schema = "file string, block bigint, line bigint, part int, closed boolean, alone boolean, text string"
    pieces = stored(tags.mapInArrow(_pieces, schema))
    whole = pieces.where("alone").select("file", "block", "line", "text").union(_joined_pieces(pieces))
    rows = whole.select("file", "block", "line", F.posexplode(html_rows(F.col("text"))).alias("pos", "row"))
    return rows.select(*POSITION, filled_rows(F.col("row")).alias("cells"))


def page_rows(
    pages: DataFrame,
    key: str,
    html: str = "html",
    row_tag: str = "tr",
    cell_tags: str = "t[dh]",
) -> DataFrame:
    """Cells of every row with any content of HTML texts held in a column: ``key, pos, cells``."""
    rows = pages.select(key, F.posexplode(html_rows(F.col(html), row_tag)).alias("pos", "row"))
    return rows.select(key, "pos", filled_rows(F.col("row"), cell_tags).alias("cells"))


def filled_cells(cells: Column) -> Column:
    return F.size(F.filter(cells, lambda c: c != ""))


def filled_rows(row: Column, cell_tags: str = "t[dh]") -> Column:
    """Cells of a row; blank rows vanish.

    A generator rather than a filter, because a filter would be pushed down and
    extract the cells a second time.
    """
    cells = F.array(html_cells(row, cell_tags))
    return F.explode(F.filter(cells, lambda c: F.exists(c, lambda x: x != "")))


def find_header(
    rows: DataFrame, position: Sequence[str] = POSITION, min_cells: int = HEADER_MIN_CELLS
) -> DataFrame:
    """First row with enough non-empty cells (no row if there is none)."""
    first = F.min_by(F.struct(*position, "cells"), F.struct(*position)).alias("header")
    enough = F.when(filled_cells(F.col("cells")) >= min_cells, F.struct(*position, "cells"))
    candidates = rows.select(F.explode(F.filter(F.array(enough), lambda r: r.isNotNull())).alias("r"))
    return candidates.select("r.*").agg(first).where("header is not null").select("header.*")


def column_names(header: Sequence[str]) -> list[str]:
    """Slugs of the header cells; empty cells become ``col_i``, repeats get ``_1``, ``_2``."""
    slugs = [slug(h) if h else f"col_{i}" for i, h in enumerate(header)]
    return [f"{s}_{slugs[:i].count(s)}" if s in slugs[:i] else s for i, s in enumerate(slugs)]


def data_rows(rows: DataFrame, header: Sequence[object], position: Sequence[str] = POSITION) -> DataFrame:
    """Rows after the header."""
    here = F.struct(*position)
    there = F.struct(*[F.lit(v).alias(p) for p, v in zip(position, header)])
    return rows.where(here > there)


def to_columns(rows: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One text column per header cell: short rows padded, long rows cut, empty cells null."""
    cells = [
        F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)
    ]
    return rows.select(*keep, *cells)


def column_types(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Type of every text column in one pass: ``name, type``.

    A column is numeric only if each of its values is a number as a whole;
    whole numbers without a missing value make it ``bigint``.
    """
    measured = [
        F.struct(
            F.lit(n).alias("name"),
            F.when(F.count(n) != F.count(number(F.col(n))), "string")
            .when(
                (F.count(whole_number(F.col(n))) == F.count("*")) & (F.count("*") > 0),
                "bigint",
            )
            .otherwise("double")
            .alias("type"),
        ).alias(f"t{i}")
        for i, n in enumerate(names)
    ]
    types = table.agg(*measured)
    return types.select(F.inline(F.array(*types.columns)))


def cast_columns(table: DataFrame, types: dict[str, str]) -> DataFrame:
    casts = {
        n: number(F.col(n)) if t == "double" else F.col(n).try_cast(t)
        for n, t in types.items()
        if t != "string"
    }
    return table.withColumns(casts) if casts else table


def type_table(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cast the columns by ``column_types``; one short row per column comes to the driver."""
    types = {r["name"]: r["type"] for r in column_types(table, names).collect()}
    return cast_columns(table, types)


def parse_report(rows: DataFrame, position: Sequence[str] = POSITION, min_cells: int = HEADER_MIN_CELLS) -> DataFrame:
    """Typed table of a report given its rows.

    The rows are stored once they are cut into cells: header, types and result
    read them, and cutting is the costly part.
    """
    rows = stored(rows)
    header = find_header(rows, position, min_cells).first()
    if header is None:
        raise ValueError(f"no row with at least {min_cells} filled cells")
    names = column_names(header["cells"])
    body = data_rows(rows, [header[p] for p in position], position)
    return type_table(to_columns(body, names), names)


def read_report(spark: SparkSession, path: str, min_cells: int = HEADER_MIN_CELLS) -> DataFrame:
    """Typed table of the report file at a path."""
    return parse_report(read_report_rows(spark, path), min_cells=min_cells)
