"""Fill-in-the-middle documents: a prefix, a middle and a suffix in one of two orders.

A text is a row of units, each a word with the white space before it (trailing white space is a unit of its
own). One ``fullmatch`` of ``(unit)*`` retains every repetition of its group, so ``ends(1)`` holds the number of
units and every place where a text may be cut. Two hashes of the document's id pick the cuts, two more whether
and in which order the parts are laid out. Python returns three numbers a text; hashes, cuts and output are Spark's.

Defined results: a null or empty text has no unit and stays plain, as does a text that holds a marker; a null id
is hashed as no digits; repeated rows and rows of one id are each transformed by themselves, with the same hashes;
other columns of any name are not looked at; an empty table gives an empty result. Texts of more than
``RUN_CHARS`` characters are matched run by run, cut where a unit ends, so captures stay bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# White space is x20 and x09 to x0D.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
UNIT_ENDS = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)

CUTS = StructType([StructField(name, LongType()) for name in ("n", "first", "second")])
# Characters matched at once; a captured unit takes some 200 bytes.
RUN_CHARS = 1_000_000


def unit_ends(text: str, run_chars: int = RUN_CHARS) -> np.ndarray:
    """Code points up to the end of each unit."""
    if len(text) <= run_chars:
        return np.array(UNITS.fullmatch(text).ends(1), np.int64)
    found, start = [], 0
    while start < len(text):
        cut = UNIT_ENDS.search(text, min(start + run_chars, len(text)))
        stop = cut.start() if cut else len(text)
        found.append(np.array(UNITS.fullmatch(text, start, stop).ends(1), np.int64))
        start = stop
    return np.concatenate(found)


def cuts_of(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """Units of a text, and the code points before its two cuts."""
    ends = unit_ends(text)
    n = len(ends)
    return n, *(int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))


@F.arrow_udf(CUTS)
def _cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    rows = zip(texts, h1.to_pylist(), h2.to_pylist())
    found = [cuts_of(text.as_py(), a, b) for text, a, b in rows]
    columns = [pa.array([row[i] for row in found], pa.int64()) for i in range(3)]
    return pa.StructArray.from_arrays(columns, CUTS.names)


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    percent: int = 50,
    suffix_first_percent: int = 80,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    ``form`` is ``plain``, ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), of ``percent`` in a
    hundred texts one of the latter two; ``spm`` of those ``suffix_first_percent``.
    """
    digits = F.coalesce(F.col(f"`{ident}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), digits), 256)
    whole = docs.select(
        F.col(f"`{ident}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), digest.alias("digest")
    )
    h = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    body, cut = F.col("text"), F.col("cut")
    marked = body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE)
    form = (
        F.when((body == "") | marked | (h[2] % 100 >= percent), "plain")
        .when(h[3] % 100 < suffix_first_percent, "spm")
        .otherwise("psm")
    )
    cutted = whole.select("doc_id", "text", form.alias("form"), _cuts("text", h[0], h[1]).alias("cut"))
    plain = F.col("form") == "plain"
    prefix = F.concat(F.lit(PREFIX), F.substr(body, F.lit(1), cut.first))
    middle = F.concat(F.lit(MIDDLE), F.substr(body, cut.first + 1, cut.second - cut.first))
    suffix = F.concat(F.lit(SUFFIX), F.substr(body, cut.second + 1))
    return cutted.select(
        "doc_id",
        cut.n.alias("n"),
        "form",
        F.when(~plain, cut.first).alias("prefix_chars"),
        F.when(~plain, cut.second - cut.first).alias("middle_chars"),
        F.when(plain, body)
        .when(F.col("form") == "psm", F.concat(prefix, suffix, middle))
        .otherwise(F.concat(suffix, prefix, middle))
        .alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made into ``output``."""

    def part(marker: str, stop: Column) -> Column:
        return F.split_part(F.split_part(output, F.lit(marker), F.lit(2)), stop, F.lit(1))

    psm = form == "psm"
    prefix = part(PREFIX, F.when(psm, SUFFIX).otherwise(MIDDLE))
    suffix = part(SUFFIX, F.when(psm, MIDDLE).otherwise(PREFIX))
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
