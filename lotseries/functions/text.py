"""Cells of HTML reports, column slugs and strict number parsing."""

from __future__ import annotations

import re
import unicodedata
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER = r"^[+-]?\d+$"
NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"

# White space as Python's str.strip() understands it.
SPACES = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def html_rows(html: Column, row_tag: str = "tr") -> Column:
    """Inner text of every row element, in order."""
    return F.regexp_extract_all(html, F.lit(f"(?is)<{row_tag}[^>]*>(.*?)</{row_tag}>"), F.lit(1))


def html_cells(row: Column, cell_tags: str = "t[dh]") -> Column:
    """Plain text of every cell of a row. Entities stay as they are."""
    found = F.regexp_extract_all(
        row, F.lit(f"(?is)<(?:{cell_tags})[^>]*>(.*?)</(?:{cell_tags})>"), F.lit(1)
    )
    return F.transform(found, clean_cell)


def clean_cell(cell: Column) -> Column:
    """Strip tags, turn no-break spaces into spaces, trim all white space."""
    plain = F.when(F.contains(cell, F.lit("<")), F.regexp_replace(cell, r"<[^>]+>", ""))
    text = F.replace(F.coalesce(plain, cell), F.lit("\u00a0"), F.lit(" "))
    return F.trim(text, F.lit(SPACES))


def slug(name: str) -> str:
    """Column name of a header cell: plain ASCII, lower case, words joined by ``_``."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"\W+", "_", plain.lower()).strip("_")


def slug_column(names: Column) -> Column:
    """``slug`` for a column of names; Spark has no Unicode decomposition of its own."""

    @F.pandas_udf("string")
    def slugs(batch: pd.Series) -> pd.Series:
        plain = batch.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")
        return plain.str.lower().str.replace(r"\W+", "_", regex=True).str.strip("_")

    return slugs(names)


def whole_number(text: Column) -> Column:
    """64-bit value of a cell that is a whole number of that range, else null."""
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def number(text: Column) -> Column:
    """Double value of a cell that is a number as a whole, else null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def first_date(name: Column) -> Column:
    """First run of eight digits in a name as text; null if there is none."""
    return F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit(""))
