"""Row-level work on alignment tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spolia.functions import align


# What tells where an alignment stands in the pairwise tables, and in which order.
PLACE = ("series1", "series2", "id1", "id2", "b1", "b2")


def complete_alignments(df: DataFrame) -> DataFrame:
    """Alignments without corrupt records and without a null in any column."""
    return df.drop("_corrupt_record").na.drop()


def clean_alignments(df: DataFrame) -> DataFrame:
    """Distinct alignments without corrupt records and without a null in any column.

    Nulls are dropped first so that incomplete rows never reach the shuffle.
    """
    return complete_alignments(df).distinct()


def placed(df: DataFrame) -> DataFrame:
    """Rows dealt out by sampled ranges of their place: equal rows meet, and tasks hold what is written together."""
    return df.repartitionByRange(*[c for c in PLACE if c in df.columns])


def placed_alignments(df: DataFrame) -> DataFrame:
    """The rows of `clean_alignments`, in one task where they are of one place.

    Equal rows have the same place, so the one shuffle that deals rows out for writing is also the one that finds
    those that repeat; the distinct behind it needs no other.
    """
    return placed(complete_alignments(df)).distinct()


def split_misfits(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Alignments whose values all fit their types, and the others (none if the source cannot have any)."""
    if "_misfit" not in df.columns:
        return df, None
    return df.where(F.col("_misfit").isNull()).drop("_misfit"), df.where(F.col("_misfit").isNotNull())


def split_unequal(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alignments with equally long sides, and the others, which no statistic is defined for."""
    same = F.length("s1") == F.length("s2")
    return df.where(same), df.where(~same)


def alignment_stats(df: DataFrame, kernel: str = "arrow") -> DataFrame:
    """Add match statistics and the copies `series_b1`, `series_b2` of the pair key.

    Rows that `pairwise.both_sides` has turned (`_turned`, not kept) count the words of the side that was the first.
    """
    words = F.col("_counts.w1")
    if "_turned" in df.columns:
        words = F.when(F.col("_turned"), F.col("_counts.w2")).otherwise(words)
    return (
        df.withColumn("_counts", align.counts(F.col("s1"), F.col("s2"), kernel))
        .withColumns(
            {
                "ch_match": F.col("_counts.ch"),
                "align_len": align.align_len(F.col("s1")),
                "matches_percent": align.matches_percent(F.col("matches"), F.length("s1")),
                "w_match": words,
                "series_b1": F.col("series1"),
                "series_b2": F.col("series2"),
            }
        )
        .drop("_counts", "_turned")
    )
