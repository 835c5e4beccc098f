"""Direction of reuse between two books."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def chrono(
    date_a: Column, author_a: Column, book_a: Column,
    date_b: Column, author_b: Column, book_b: Column,
) -> Column:
    """Place of book `a` relative to book `b`.

    Different dates decide alone (`chron` / `anachron`).  For equal dates one direction of
    every pair is kept by name order: within one author `sr_include` / `sr_exclude`,
    otherwise `include` / `exclude`.  Null when a date is no integer.
    """
    year_a, year_b = date_a.try_cast("int"), date_b.try_cast("int")
    same_author = F.when(book_a < book_b, "sr_include").otherwise("sr_exclude")
    other_author = F.when(author_a < author_b, "include").otherwise("exclude")
    tie = F.when(author_a == author_b, same_author).otherwise(other_author)
    return F.when(year_a > year_b, "chron").when(year_a < year_b, "anachron").when(year_a == year_b, tie)
