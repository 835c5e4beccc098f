"""Cells of tab-separated files without line breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The escapes of text tables as databases load them.
ESCAPES = {"\n": "\\n", "\r": "\\r"}


def escape_cell(text: Column) -> Column:
    """Line breaks as a backslash and a letter, a backslash as two."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, mark in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape_cell(text: Column) -> Column:
    """The text that `escape_cell` was given.

    Cut at doubled backslashes, whatever escape is left stands for itself; most cells have no backslash at all.
    """
    parts = F.transform(F.split(text, r"\\\\", -1), _without_marks)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def _without_marks(part: Column) -> Column:
    for plain, mark in ESCAPES.items():
        part = F.replace(part, F.lit(mark), F.lit(plain))
    return part


def _strings(df: DataFrame, columns: list[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in columns if kinds[c] == "string"]


def escaped_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """The string columns among `columns` with `escape_cell`."""
    return df.withColumns({c: escape_cell(F.col(c)) for c in _strings(df, columns)})


def unescaped_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """The string columns among `columns` with `unescape_cell`."""
    return df.withColumns({c: unescape_cell(F.col(c)) for c in _strings(df, columns)})
