"""Cutting texts into milestones of a fixed number of tokens.

A text is one row and stays one row: cutting, labelling, rebuilding and checking are
expressions on it and need no shuffle.  Only the numbering over the parts of a split book
looks at several rows, and it does so on file names and counts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from spolia import config
from spolia.functions import text as txt
from spolia.operators.corpus import file_key, folder
from spolia.operators.once import computed_once, exploded

VERSION = ["book_uri", "version"]


def prepare_texts(
    texts: DataFrame,
    ms_regex: str | None = config.MS_TAG_SPACED,
    splitter: str | None = config.SPLITTER,
) -> DataFrame:
    """Split files into `header, marker, body` and strip earlier tags from the body.

    Without a splitter the whole file is body.  Rows without one where it is expected keep
    a null body, see `rejects`.
    """
    if splitter is None:
        parts = F.struct(
            F.lit("").alias("header"), F.lit("").alias("marker"), F.col("value").alias("body")
        )
    else:
        parts = txt.split_header(F.col("value"), splitter)
    return (
        texts.withColumn("_parts", parts)
        .withColumn("body", txt.strip_milestones(F.col("_parts.body"), ms_regex))
        .withColumns({"header": F.col("_parts.header"), "marker": F.col("_parts.marker")})
        .drop("_parts", "value")
    )


def token_rows(texts: DataFrame, token_class: str = config.TOKEN_CLASS) -> DataFrame:
    """One row per piece of text: `file_name, pos, piece, relevant`."""
    return texts.select("file_name", F.posexplode(txt.tokenize(F.col("body"))).alias("pos", "piece")).withColumn(
        "relevant", txt.token_flag(F.col("piece"), token_class)
    )


def assign_milestones(
    texts: DataFrame, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS
) -> DataFrame:
    """Add `milestones` (array of texts) and `width` (digits of a label).

    Both are computed once for a text: otherwise the labels would count its tokens again for each milestone.
    """
    return computed_once(
        texts,
        {
            "milestones": txt.cut_milestones(F.col("body"), ms_len, token_class),
            "width": txt.label_width(F.col("body"), ms_len, token_class),
        },
    )


def number_parts(texts: DataFrame, listing: DataFrame, by_folder: bool = False) -> DataFrame:
    """Where every file of a split book starts: its key (path or name), `start[, unsound]`.

    With `by_folder` books are told apart by folder too.  Numbering continues only if every file of the version is a part, separately per
    language and extension.  `unsound` tells, if `texts` has a `reason`, whether any part of
    the same book was rejected.  Works on names and counts; a group holds one row per part.
    `listing` holds the names of all files.
    """
    key, place = file_key(texts), folder(by_folder).alias("folder")
    unsplit = listing.where(F.col("part").isNull()).select(place, *VERSION).distinct()
    book = Window.partitionBy("folder", *VERSION, "lang_ext")
    earlier = book.orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    checked = "reason" in texts.columns
    flag = [F.col("reason").isNotNull().alias("bad")] if checked else []
    return (
        texts.where(F.col("part").isNotNull())
        .select(*dict.fromkeys((key, "file_name")), place, *VERSION, "lang_ext", F.size("milestones").cast("bigint").alias("n"), *flag)
        .join(unsplit, ["folder", *VERSION], "left_anti")
        .select(
            key,
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
            *([F.max("bad").over(book).alias("unsound")] if checked else []),
        )
    )


def continue_numbering(texts: DataFrame, listing: DataFrame | None = None, by_folder: bool = False) -> DataFrame:
    """Add `start`, the number of milestones in earlier parts of the same book.

    Unsplit texts pass through; only the parts of split books are joined with their
    starts.  An unsound part makes its whole book unsound, since later numbers depend on it.
    `listing` gives the names of the same files without the work already planned on them.
    """
    listing = texts if listing is None else listing
    zero = F.lit(0).cast("bigint")
    single = texts.where(F.col("part").isNull()).withColumn("start", zero)
    parts = (
        texts.where(F.col("part").isNotNull())
        .join(number_parts(texts, listing, by_folder), file_key(texts), "left")
        .withColumn("start", F.coalesce("start", zero))
    )
    if "reason" in texts.columns:
        parts = parts.withColumn(
            "reason", F.coalesce("reason", F.when(F.col("unsound"), "other part rejected"))
        ).drop("unsound")
    return single.unionByName(parts)


def milestone_rows(texts: DataFrame) -> DataFrame:
    """One row per milestone: `file_name, n, ms_label, text` (n counts from 1 in the file)."""
    kept = ["file_name", "part", "start", "width"]
    return exploded(texts, kept, "milestones", "_i", "text").select(
        "file_name",
        (F.col("_i") + 1).alias("n"),
        txt.milestone_label(F.col("part"), F.col("start") + F.col("_i") + 1, F.col("width")).alias("ms_label"),
        "text",
    )


def rebuild_text(texts: DataFrame) -> DataFrame:
    """Add `tagged`, the body with a tag after every milestone."""
    return texts.withColumn(
        "tagged",
        txt.tagged_body(F.col("milestones"), F.col("part"), F.col("start"), F.col("width")),
    )


def check_milestones(
    texts: DataFrame, ms_regex: str = config.MS_TAG_SPACED, max_residual: int = 1
) -> DataFrame:
    """Add `reason`: why a text must not be used, null if it is sound.

    In order: no splitter, too many tags left after stripping, text damaged by the tags,
    a label given twice.  The result does not depend on where the numbering starts.
    """
    trial = txt.tagged_body(F.col("milestones"), F.col("part"), F.lit(0), F.col("width"))
    labels = F.regexp_extract_all("_trial", F.lit(ms_regex), 0)
    reason = (
        F.when(F.col("body").isNull(), "missing splitter")
        .when(txt.residual_tags(F.col("body"), ms_regex) > max_residual, "remaining tags")
        .when(F.regexp_replace("_trial", ms_regex, "") != F.col("body"), "text changed")
        .when(F.size(F.array_distinct("_labels")) < F.size("_labels"), "duplicate labels")
    )
    tried = texts.withColumn("_trial", trial).withColumn("_labels", labels)
    return computed_once(tried, {"reason": reason}).drop("_trial", "_labels")


def split_rejects(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound texts, and `file_name, reason` of the others."""
    sound = texts.where(F.col("reason").isNull()).drop("reason")
    return sound, texts.where(F.col("reason").isNotNull()).select("file_name", "reason")


def milestoned_files(texts: DataFrame) -> DataFrame:
    """`file_name, value`: the complete tagged file, header and splitter included."""
    content = F.concat(
        txt.right_trim(F.col("header")), F.lit("\n\n"), F.col("marker"), F.lit("\n\n"), F.col("tagged")
    )
    return texts.select(
        "file_name", F.trim(content, F.lit(config.WHITESPACE)).alias("value")
    )
