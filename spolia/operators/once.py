"""Keeping costly columns from being evaluated repeatedly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`withColumns` for costly expressions that later filters refer to.

    A filter on a projected column is pushed below the projection by repeating the column's
    expression; a one-element generator keeps it above, so the value is computed once.
    """
    kept = [c for c in df.columns if c not in columns]
    values = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*kept, F.inline(F.array(values)))


def exploded(df: DataFrame, kept: list[str], array: str, pos: str, value: str) -> DataFrame:
    """`posexplode` of a costly array column.

    For a plain explode Spark infers a filter on the size of the array and pushes it below
    the array's computation, which then runs twice; the outer form does without.
    """
    rows = df.select(*kept, F.posexplode_outer(array).alias(pos, value))
    return rows.where(F.col(pos).isNotNull())
