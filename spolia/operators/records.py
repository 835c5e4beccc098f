"""Milestone records: one row per milestone, ready for alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spolia import config
from spolia.functions import text as txt
from spolia.functions.letters import fold_letters
from spolia.operators.once import computed_once, exploded


def explode_milestones(texts: DataFrame, ms_regex: str = config.MS_TAG, body: str = "body") -> DataFrame:
    """Cut bodies at their tags: one row per milestone with `pos, ms_label, text`.

    A milestone is the text since the previous tag; text after the last tag is dropped.
    """
    kept = [c for c in texts.columns if c != body]
    # Each step once for a text: the body is searched twice, and the pieces are taken and counted.
    once = computed_once(texts.select(*kept, F.col(body).alias("_body")), {"_body": F.col("_body")})
    cut = {"_labels": F.regexp_extract_all("_body", F.lit(ms_regex), 0), "_pieces": F.split("_body", ms_regex, -1)}
    once = computed_once(once, cut)
    pairs = F.arrays_zip(
        F.col("_labels").alias("ms_label"), F.slice("_pieces", 1, F.size("_pieces") - 1).alias("text")
    )
    return exploded(once.withColumn("_pairs", pairs), kept, "_pairs", "_i", "_ms").select(
        *kept, (F.col("_i") + 1).alias("pos"), "_ms.ms_label", "_ms.text"
    )


def to_records(
    milestones: DataFrame,
    include_book_uri: bool = False,
    extra_map: dict[str, str] | None = None,
    fold: bool = False,
) -> DataFrame:
    """Record columns `id, series, text, seq[, book_uri]`, plus `pos` for chunking.

    With `fold` marks and letter forms are folded before the text is normalised.
    """
    text = fold_letters(F.col("text")) if fold else F.col("text")
    columns = [
        F.concat_ws(".", "series", "ms_label").alias("id"),
        F.col("series"),
        txt.clean_text(text, extra_map).alias("text"),
        txt.milestone_seq(F.col("ms_label")).alias("seq"),
    ]
    if include_book_uri:
        columns.append(F.col("book_uri"))
    return milestones.select(*columns, "pos")


def with_chunk(records: DataFrame, rows: int = config.CHUNK_ROWS) -> DataFrame:
    """Add `chunk`: the record's position in its text, rounded up to a multiple of `rows`.

    The position comes from the cut itself, so no ranking over the series is needed.
    """
    number = (F.ceil(F.col("pos") / F.lit(rows)) * rows).cast("string")
    return records.withColumn("chunk", F.lpad(number, F.greatest(F.lit(5), F.length(number)), F.lit("0")))
