"""Explicit schemas of the persisted tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_STR, _INT, _LONG, _DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

RECORDS = _struct(("id", _STR), ("series", _STR), ("text", _STR), ("seq", _LONG), ("book_uri", _STR))

METADATA = _struct(
    ("id", _STR), ("status", _STR), ("tok_length", _STR), ("char_length", _STR),
    ("date", _STR), ("author_lat", _STR), ("book", _STR),
)

# The names and the order of the columns below are those of the aligner's table and of the output files.
# One aligned passage; the columns ending in 1 / 2 describe its two sides.
ALIGNMENTS = _struct(
    ("b1", _INT), ("b2", _INT), ("bw1", _INT), ("bw2", _INT),
    ("e1", _INT), ("e2", _INT), ("ew1", _INT), ("ew2", _INT),
    ("first1", _LONG), ("first2", _LONG), ("gid1", _LONG), ("gid2", _LONG),
    ("id1", _STR), ("id2", _STR), ("len1", _INT), ("len2", _INT),
    ("matches", _INT), ("s1", _STR), ("s2", _STR), ("score", _DBL),
    ("seq1", _INT), ("seq2", _INT), ("series1", _STR), ("series2", _STR),
    ("tok1", _INT), ("tok2", _INT), ("uid1", _LONG), ("uid2", _LONG),
)
# What the operators cannot do without; the rest is carried along.
ALIGNMENT_REQUIRED = (
    "b1", "b2", "bw1", "bw2", "id1", "id2", "matches", "s1", "s2", "seq1", "seq2", "series1", "series2",
)

# Column order of a pairwise file (its directory carries series1 / series2).
PAIRWISE_COLUMNS = (
    "align_len", "b1", "b2", "bw1", "bw2", "ch_match", "e1", "e2", "ew1", "ew2", "gid1", "gid2",
    "id1", "id2", "len1", "len2", "matches", "matches_percent", "s1", "s2", "score", "seq1", "seq2",
    "series_b1", "series_b2", "tok1", "tok2", "uid1", "uid2", "w_match", "first1", "first2",
)
_PAIRWISE_TYPES = {f.name: f.dataType for f in ALIGNMENTS.fields} | {
    "align_len": _INT, "ch_match": _INT, "w_match": _INT, "matches_percent": _DBL,
    "series_b1": _STR, "series_b2": _STR,
}
PAIRWISE = T.StructType(
    [T.StructField(name, _PAIRWISE_TYPES[name], True) for name in PAIRWISE_COLUMNS]
)

BOOK_STATS_COLUMNS = (
    "_T1", "_T2", "instances", "WM2_Total", "WM1_Total", "CM2_Total", "CM1_Total",
    "ch_MATCHES_Min", "ch_MATCHES_Max", "ch_MATCHES_Mean",
    "date_B1", "date_B2", "author_B1", "author_B2", "book1", "book2",
    "tok_length_B1", "tok_length_B2", "ch_length_B1", "ch_length_B2",
    "WM_B2inB1", "WM_B1inB2", "CM_B2inB1", "CM_B1inB2", "chrono_B1B2", "chrono_B2B1",
)


def typed_schema(names: list[str]) -> T.StructType:
    """Schema for `names` in their order, string for columns without a known type."""
    return T.StructType([T.StructField(n, _PAIRWISE_TYPES.get(n, _STR), True) for n in names])
