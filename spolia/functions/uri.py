"""File names and version identifiers as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spolia import config


def short_id(series: Column) -> Column:
    """Version ID without language and extension: everything before the first `-`."""
    return F.substring_index(series, "-", 1)


def parse_uri(name: Column) -> Column:
    """Split `<author>.<title>.<version>[<part>]-<lang>[.<ext>]` into a struct of strings.

    `version` is stripped of the part letter; `part` and `ext` are null where absent.
    `series` is the name without author and title, the identifier used downstream.
    """
    # The pattern of every field, each applied to the name once.
    patterns = {
        "author": r"^([^.]*)",
        "title": r"^[^.]*\.([^.]*)",
        "book_uri": r"^([^.]*\.[^.]*)",
        "series": r"^[^.]*\.[^.]*\.(.*)$",
        "version": r"^[^.]*\.[^.]*\.([^-]*?)[A-Z]?(?:-|$)",
        "part": r"^[^.]*\.[^.]*\.[^-]*([A-Z])(?:-|$)",
        "lang": r"^[^-]*-([^.]*)",
        "ext": r"\.(mARkdown|completed|inProgress)$",
        "lang_ext": r"^[^-]*-(.*)$",
    }
    optional = ("part", "ext")
    return F.struct(
        *[
            (F.nullif(F.regexp_extract(name, p, 1), F.lit("")) if field in optional
             else F.regexp_extract(name, p, 1)).alias(field)
            for field, p in patterns.items()
        ]
    )


def with_uri(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add the fields of `parse_uri` as columns."""
    return df.withColumn("_uri", parse_uri(F.col(name))).select(*df.columns, "_uri.*")


def extension_priority(ext: Column) -> Column:
    """Rank of a file extension, larger is more developed; no extension is 0."""
    rank = F.lit(0)
    for value, name in enumerate(reversed(config.EXTENSIONS), start=1):
        rank = F.when(ext == name, value).otherwise(rank)
    return rank
