"""Chart feeds as one nested document: lot -> traces of its cycles -> parallel arrays, then the lot's events.

The document is a table of pieces of text, one per value and per bracket, with the keys that put them in order. Each
piece says by itself what comes before it (a comma or none), because the first value of every array is found
beforehand by an aggregate. So the document is written by a range sort alone: a lot of any size spreads over
tasks, and no task holds more of it than the piece at hand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotseries.operators.reports import CURVE_COLORS, HISTORY_COLORS
from lotseries.sources.stored import stored

# Fixed value: label of the points without a cycle end.
OPEN_LABEL = "sin cierre"

# Sections of a lot: its opening, traces, the bracket between, events, its end.
OPENING, TRACES, BETWEEN, EVENTS, END = range(5)
# Within a field: the bracket before it, its first value, the others.
BRACKET, FIRST, OTHER = range(3)


def quoted(text: Column) -> Column:
    """A text as JSON, null as ``null``."""
    one = F.to_json(F.array(text.cast("string")))
    return F.when(text.isNull(), "null").otherwise(F.substr(one, F.lit(2), F.length(one) - 2))


def number(value: Column, digits: int = 4) -> Column:
    """A number as JSON with fixed digits, null as ``null``."""
    plain = F.round(value.cast("double"), digits).cast(f"decimal(20,{digits})") if digits else value.cast("long")
    return F.coalesce(plain.cast("string"), F.lit("null"))


def _pieces(
    df: DataFrame, keys: Sequence[str], section: Column, cycle: Column, field: Column, place: Column, text: Column, **at: Column
) -> DataFrame:
    return df.select(
        "lot_id", section.alias("section"), cycle.isNull().alias("is_open"), cycle.cast("string").alias("cycle"),
        field.alias("field"), place.alias("place"), *[at.get(k, F.lit(None)).alias(k) for k in keys], text.alias("text"),
    )


def _numbered(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stored rows with ``uid``, and ``is_first`` for one row of each group: the first in order."""
    rows = stored(df.withColumn("uid", F.monotonically_increasing_id()))
    first = rows.groupBy(*group).agg(F.min(F.struct(*order, "uid")).alias("first"))
    marks = first.select(F.col("first.uid").alias("uid"), F.lit(True).alias("is_first"))
    return rows.join(marks, "uid", "left").withColumn("is_first", F.coalesce("is_first", F.lit(False)))


def _place() -> Column:
    return F.when(F.col("is_first"), FIRST).otherwise(OTHER)


def _comma(first: Column) -> Column:
    return F.when(first, "").otherwise(",")


def feed_pieces(
    points: DataFrame,
    cycle: str,
    fields: dict[str, Column],
    order: Sequence[str],
    colors: int = CURVE_COLORS,
    open_label: str | None = None,
    events: DataFrame | None = None,
    event: dict[str, Column] | None = None,
    event_order: Sequence[str] = (),
) -> DataFrame:
    """Pieces of the document: ``lot_id, section, is_open, cycle, field, place``, values to order by, ``text``.

    ``points`` become one trace per lot and cycle, in order of the cycle: ``label``, ``color`` (rank of the cycle modulo the
    palette) and an array per field, whose values are JSON texts in the given order. With ``open_label``
    points without a cycle form one more trace, the last, without a color; else they are left out. ``events`` become
    objects of the lot's ``renovations``; events of lots without points are left out.
    """
    keys = [f"at{i}" for i in range(len(order))] + [f"event{i}" for i in range(len(event_order))]
    named = {f"_v{i}": c for i, c in enumerate(fields.values())}
    kept = points if open_label else points.where(F.col(cycle).isNotNull())
    plain = kept.select("lot_id", F.col(cycle).alias("_cycle"), *order, *[c.alias(k) for k, c in named.items()])
    values = _numbered(plain, ["lot_id", "_cycle"], list(order))
    at = {f"at{i}": F.col(c) for i, c in enumerate(order)}
    body = F.array(
        *[
            F.struct(F.lit(i).alias("field"), F.concat(_comma(F.col("is_first")), F.col(k)).alias("text"))
            for i, k in enumerate(named)
        ]
    )
    spread = values.select("lot_id", "_cycle", *order, _place().alias("place"), F.inline(body))
    whole = F.col("_cycle")
    found = _pieces(spread, keys, F.lit(TRACES), whole, F.col("field"), F.col("place"), F.col("text"), **at)

    by_lot = W.partitionBy("lot_id").orderBy(F.col("_cycle").asc_nulls_last())
    traces = values.select("lot_id", "_cycle").distinct().withColumn("rank", F.row_number().over(by_lot))
    traces = stored(traces)
    color = F.when(whole.isNotNull(), ((F.col("rank") - 1) % colors).cast("string")).otherwise("null")
    head = F.concat(
        _comma(F.col("rank") == 1),
        F.lit('{"label":'), F.coalesce(F.when(whole.isNotNull(), quoted(whole)), F.lit(f'"{open_label}"')),
        F.lit(',"color":'), color,
    )
    names = list(fields)
    brackets = [F.concat(head, F.lit(f',"{names[0]}":['))]
    brackets += [F.lit(f'],"{name}":[') for name in names[1:]] + [F.lit("]}")]
    frames = F.array(*[F.struct(F.lit(i).alias("field"), b.alias("text")) for i, b in enumerate(brackets)])
    opened = traces.select("lot_id", "_cycle", F.inline(frames))
    found = found.union(_pieces(opened, keys, F.lit(TRACES), whole, F.col("field"), F.lit(BRACKET), F.col("text")))

    lots = traces.select("lot_id").distinct()
    ends = [(OPENING, F.concat(F.lit('{"label":'), quoted(F.col("lot_id")), F.lit(',"traces":[')))]
    ends += [(BETWEEN, F.lit('],"renovations":[')), (END, F.lit("]}\n"))] if events is not None else [(END, F.lit("]}\n"))]
    parts = F.array(*[F.struct(F.lit(s).alias("section"), x.alias("text")) for s, x in ends])
    none = F.lit(None).cast("string")
    framed = lots.select("lot_id", F.inline(parts))
    found = found.union(_pieces(framed, keys, F.col("section"), none, F.lit(0), F.lit(BRACKET), F.col("text")))

    if events is not None:
        items = [F.concat(F.lit(f'{"," if i else ""}"{name}":'), c) for i, (name, c) in enumerate((event or {}).items())]
        texts = F.concat(F.lit("{"), *items, F.lit("}"))
        known = events.join(lots, "lot_id", "left_semi").select("lot_id", *event_order, texts.alias("text"))
        marked = _numbered(known, ["lot_id"], list(event_order))
        text = F.concat(_comma(F.col("is_first")), F.col("text"))
        placed = {f"event{i}": F.col(c) for i, c in enumerate(event_order)}
        found = found.union(_pieces(marked, keys, F.lit(EVENTS), none, F.lit(0), _place(), text, **placed))
    return found


def ordered(pieces: DataFrame) -> DataFrame:
    """Pieces in the order of the document, over all tasks."""
    keys = [c for c in pieces.columns if c != "text"]
    return pieces.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_feed(pieces: DataFrame, path: str) -> None:
    """The document as text files, one lot a line; a lot may go on in the next file.

    The files in order of their names, put one behind the other, are the document.
    """
    ordered(pieces).select("text").write.mode("overwrite").option("lineSep", " ").text(path)


def lot_feed(history: DataFrame, markers: DataFrame) -> DataFrame:
    """Pieces of the feed of ``lot_history`` with ``renovation_markers`` as events."""
    fields = {
        "fecha": quoted(F.col("obs_date")),
        "ndvi": number(F.col("ndvi_ref")),
        "edad": number(F.col("crop_age_days"), 0),
    }
    event = {**fields, "cierre_ciclo": quoted(F.col("cycle_end"))}
    order = ["obs_date", "ndvi_ref", "crop_age_days"]
    return feed_pieces(
        history, "cycle_end", fields, order, HISTORY_COLORS, OPEN_LABEL, markers, event, [*order, "cycle_end", "kind"]
    )


def growth_feed(curves: DataFrame) -> DataFrame:
    """Pieces of the feed of ``growth_curves``: traces by age, without events."""
    fields = {
        "edad": number(F.col("crop_age_days"), 0),
        "stac": number(F.col("ndvi_corrected")),
        "ref": number(F.col("ndvi_ref")),
        "fecha": quoted(F.col("obs_date")),
        "id_img": quoted(F.col("image_id")),
    }
    return feed_pieces(curves, "harvest", fields, ["crop_age_days", "obs_date", "image_id", "ndvi_ref", "ndvi_corrected"])


def renovated_feed(history: DataFrame, at_events: DataFrame) -> DataFrame:
    """Pieces of the feed of ``renovated_history`` with ``values_at_events`` as events."""
    fields = {
        "fecha": quoted(F.col("obs_date")),
        "edad": number(F.col("crop_age_days"), 0),
        "ndvi": number(F.col("ndvi_ref")),
    }
    event = {
        "fecha": quoted(F.col("renovation_date")),
        "ndvi": number(F.col("ndvi")),
        "edad": number(F.col("age"), 0),
        "cierre": quoted(F.col("harvest")),
    }
    order = ["obs_date", "ndvi_ref", "crop_age_days"]
    return feed_pieces(history, "harvest", fields, order, events=at_events, event=event, event_order=["harvest", "renovation_date"])
