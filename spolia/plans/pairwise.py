"""Alignments to tables per book pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spolia.operators import alignments as al, pairwise as pw
from spolia.sources import readers, writers


def pairwise_tables(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    both_directions: bool = False,
    fmt: str | None = None,
    kernel: str = "arrow",
    columns: list[str] | None = None,
    rejects_path: str | None = None,
    escape: bool = True,
) -> DataFrame:
    """Write the pairwise tables of an alignment dataset.

    Whole rows are shuffled once, to where they are written; there the repeated ones are found (`pairwise_rows`).
    Returns the alignments left out because their sides differ in length.  Rows with values that do not fit the types
    are written to `rejects_path` (default: `out_path` with "-rejects").  `columns` spares a pass over JSON.
    """
    fitting = fitting_alignments(spark, in_path, rejects_path or f"{out_path.rstrip('/')}-rejects", fmt, columns)
    rows = pairwise_rows(fitting, both_directions, kernel)
    writers.write_pairwise(rows, out_path, escape, is_placed=True)
    return al.split_unequal(al.clean_alignments(fitting))[1]


def pairwise_rows(alignments: DataFrame, both_directions: bool = False, kernel: str = "arrow") -> DataFrame:
    """Distinct complete alignments with statistics, dealt out by place.

    With `both_directions` rows are turned before the shuffle, as turned rows belong elsewhere.
    """
    usable, _ = al.split_unequal(al.complete_alignments(alignments))
    return al.alignment_stats(al.placed_alignments(pw.both_sides(usable) if both_directions else usable), kernel)


def fitting_alignments(
    spark: SparkSession, in_path: str, rejects_path: str, fmt: str | None = None, columns: list[str] | None = None
) -> DataFrame:
    """The alignments whose values fit their types; the others are written to `rejects_path` as JSON."""
    fitting, misfits = al.split_misfits(readers.read_alignments(spark, in_path, fmt, columns, misfits=True))
    if misfits is not None:
        misfits.write.mode("overwrite").json(rejects_path)
    return fitting


def mirror_tables(spark: SparkSession, in_path: str, out_path: str, recompute: bool = False) -> None:
    """Write existing pairwise tables in both directions to a new place.

    Tables that are there in both directions already are taken in one, so a second run changes nothing.
    """
    tables = pw.one_direction(readers.read_pairwise(spark, in_path))
    writers.write_pairwise(pw.bidirectional(tables, recompute), out_path)
