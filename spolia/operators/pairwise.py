"""Tables per book pair and their reversal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spolia.functions import align


def _mirror(name: str, columns: list[str]) -> str:
    """The same property of the other side; columns without a side stay as they are."""
    other = {"1": "2", "2": "1"}.get(name[-1:])
    twin = name[:-1] + other if other else name
    return twin if twin in columns else name


def _flipped(columns: list[str], recompute: bool, kernel: str) -> list[Column]:
    flipped = [F.col(_mirror(c, columns)).alias(c) for c in columns]
    if recompute:
        mask = align.diff_mask(F.col("s2"), F.col("s1"), kernel)
        flipped[columns.index("w_match")] = align.w_match_of(mask).alias("w_match")
    return flipped


def flip(df: DataFrame, recompute: bool = False, kernel: str = "builtin") -> DataFrame:
    """The same alignments seen from the other book.

    `w_match` is defined by the words of side 1 but kept as it is, unless `recompute`.
    """
    return df.select(*_flipped(df.columns, recompute, kernel))


def one_direction(df: DataFrame) -> DataFrame:
    """Alignments of book pairs in one direction: where both are there, that with the smaller `series1` stays."""
    pairs = df.select("series1", "series2").distinct()
    mirrored = pairs.where("series1 < series2").select(F.col("series2").alias("series1"), F.col("series1").alias("series2"))
    return df.join(mirrored, ["series1", "series2"], "left_anti").select(*df.columns)


def bidirectional(df: DataFrame, recompute: bool = False, kernel: str = "builtin") -> DataFrame:
    """Every alignment in both directions.

    Both rows are produced from one pass over the input instead of a union of two.  Each
    pair is expected in one direction only.
    """
    both = F.array(
        F.struct(*df.columns), F.struct(*_flipped(df.columns, recompute, kernel))
    )
    return df.select(F.inline(both))


def both_sides(df: DataFrame) -> DataFrame:
    """Alignments without statistics in both directions, `_turned` telling the reversed ones.

    `alignment_stats` gives them the figures that `bidirectional` copies.
    """
    turned = [F.col(_mirror(c, df.columns)).alias(c) for c in df.columns]
    rows = F.array(F.struct(*df.columns, F.lit(False).alias("_turned")), F.struct(*turned, F.lit(True).alias("_turned")))
    return df.select(F.inline(rows))


def pair_counts(df: DataFrame) -> DataFrame:
    """Alignments per book pair with a summary of the aligner's match counts."""
    return df.groupBy("series1", "series2").agg(
        F.count("matches").alias("instances"),
        F.min("matches").alias("matches_min"),
        F.max("matches").alias("matches_max"),
        F.avg("matches").alias("matches_mean"),
    )
