"""Alignments, records and metadata to book-pair statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spolia import config
from spolia.operators import bookstats
from spolia.operators.alignments import clean_alignments, split_unequal
from spolia.plans.pairwise import fitting_alignments
from spolia.sources import readers, writers


def book_statistics(
    spark: SparkSession,
    records_path: str,
    alignments_path: str,
    metadata_path: str,
    out_path: str,
    fmt: str | None = None,
    ms_len: int = config.MS_LEN,
    offset_mode: str = "inclusive",
    compat: bool = True,
    single_file: bool = False,
    kernel: str = "arrow",
    columns: list[str] | None = None,
    rejects_path: str | None = None,
) -> None:
    """Write the book-pair table as gzipped TSV.

    Alignments with values that do not fit the types are written to `rejects_path` (default: `out_path` with
    "-rejects"); `data_quality` tells what else is left out.  `columns` spares a pass over JSON.
    """
    rejects_path = rejects_path or f"{out_path.rstrip('/')}-rejects"
    stats = bookstats.book_pair_stats(
        fitting_alignments(spark, alignments_path, rejects_path, fmt, columns),
        readers.read_records(spark, records_path),
        readers.read_metadata(spark, metadata_path),
        ms_len, offset_mode, compat, kernel,
    )
    writers.write_book_stats(stats, out_path, single_file)


def data_quality(
    spark: SparkSession, records_path: str, alignments_path: str, fmt: str | None = None
) -> dict[str, DataFrame]:
    """What the statistics leave out or would count twice, as tables.

    `lost`: alignments whose milestones have no record; `shared`: milestones two series
    have in common once language and extension are dropped; `unequal`: alignments whose
    sides differ in length.
    """
    cleaned = clean_alignments(readers.read_alignments(spark, alignments_path, fmt))
    usable, unequal = split_unequal(cleaned)
    records = readers.read_records(spark, records_path)
    keys = bookstats.compared(usable).drop("marks")
    return {
        "lost": bookstats.lost_alignments(keys, records),
        "shared": bookstats.duplicate_milestones(records),
        "unequal": unequal,
    }
