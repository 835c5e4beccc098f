"""Choosing and assembling text versions.

Input is one row per file: `file_name`, the whole file in `value`, and the columns of
`functions.uri.with_uri`.  Decisions are taken on the narrow columns only; the texts
follow by a filter, so a text is shuffled at most once and usually not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spolia import config
from spolia.functions import text as txt
from spolia.functions.uri import extension_priority

BOOK_VERSION = ["book_uri", "version", "lang"]


def filter_names(df: DataFrame, regex: str = config.FILE_NAME, name: str = "file_name") -> DataFrame:
    """Keep the files whose name follows the naming scheme."""
    return df.where(F.col(name).rlike(regex))


def primary_ids(metadata: DataFrame) -> DataFrame:
    """Distinct version IDs marked for primary analysis."""
    return metadata.where(F.col("status") == "pri").select(F.col("id").alias("version")).distinct()


def filter_primary(texts: DataFrame, metadata: DataFrame, enabled: bool = True) -> DataFrame:
    """Keep files of primary versions; everything when not `enabled`."""
    return texts.join(primary_ids(metadata), "version", "left_semi") if enabled else texts


def file_key(df: DataFrame) -> str:
    """What tells files apart: their path where it is known, their name otherwise."""
    return "path" if "path" in df.columns else "file_name"


def folder(by_folder: bool) -> Column:
    """The folder of each file, or one and the same where versions may be spread over folders."""
    return F.regexp_replace("path", "/[^/]*$", "") if by_folder else F.lit("")


def chosen_versions(texts: DataFrame, by_folder: bool = False) -> DataFrame:
    """Key of the best annotated file of every version, language and part; the first path of equal names.

    With `by_folder` a version in two folders is two versions.
    """
    key = file_key(texts)
    rank = F.struct(-extension_priority(F.col("ext")), F.col(key))
    return (
        texts.groupBy(folder(by_folder).alias("folder"), *BOOK_VERSION, "part")
        .agg(F.min_by(key, rank).alias(key))
        .select(key)
    )


def select_version(texts: DataFrame, listing: DataFrame | None = None, by_folder: bool = False) -> DataFrame:
    """Keep one file per version: mARkdown, completed, inProgress, no extension, in this order.

    `listing` holds the candidates without their content, `texts` itself by default.
    """
    chosen = chosen_versions(texts if listing is None else listing, by_folder)
    return texts.join(chosen, chosen.columns[0], "left_semi")


def same_names(listing: DataFrame, chosen: DataFrame) -> DataFrame:
    """Files that were not chosen because one of the same name was (`path, file_name, reason`)."""
    names = listing.join(chosen, "path", "left_semi").select("file_name").distinct()
    others = listing.join(chosen, "path", "left_anti").join(names, "file_name", "left_semi")
    return others.select("path", "file_name", F.lit("same name in another folder").alias("reason"))


def with_body(texts: DataFrame, splitter: str = config.SPLITTER) -> DataFrame:
    """Replace the file content by the text after the header (null if there is no splitter)."""
    return texts.withColumn("body", txt.body_after(F.col("value"), splitter)).drop("value")


def missing_splitter(texts: DataFrame, splitter: str = config.SPLITTER) -> DataFrame:
    """Files that cannot be used because nothing separates header and text."""
    return texts.where(F.instr("value", F.lit(splitter)) == 0).select(
        "file_name", F.lit("missing splitter").alias("reason")
    )


def with_reason(texts: DataFrame, splitter: str = config.SPLITTER, by_folder: bool = False) -> DataFrame:
    """The files without their content and with `reason`: why a file must not be used, null if it may be.

    A file without splitter is unusable, and with it all parts of its book.  With `by_folder`, of a version that
    stands in several folders the first folder with a usable file counts.  Only narrow rows are grouped, one
    per part of a book.
    """
    names = texts.withColumn("_folder", folder(by_folder)).withColumn("_bad", F.instr("value", F.lit(splitter)) == 0).drop("value")
    book = Window.partitionBy("_folder", *BOOK_VERSION, F.col("part").isNull())
    broken = F.when(F.col("_bad"), "missing splitter").when(
        F.col("part").isNotNull() & F.max("_bad").over(book), "other part rejected"
    )
    judged = names.withColumn("_broken", broken)
    first = F.min(F.when(F.col("_broken").isNull(), F.col("_folder"))).over(Window.partitionBy("version", "lang"))
    again = F.when(F.col("_folder") != first, "version in another folder")
    return judged.withColumn("reason", F.coalesce("_broken", again)).drop("_folder", "_bad", "_broken")


def merge_parts(texts: DataFrame, by_folder: bool = False) -> DataFrame:
    """Join the parts A, B, ... of a split book into one text.

    The merged text is named after the version without part letter, with language and
    extension of the first part.  A part is one capital letter, so a group holds at most
    26 rows after `select_version`; unsplit texts are passed through without a shuffle.
    A book with a part without body has no body itself.
    Needs `body`; gives `series, book_uri, version, lang, body`.
    """
    columns = ["series", *BOOK_VERSION, "body"]
    single = texts.where(F.col("part").isNull()).select(*columns)
    piece = F.struct("file_name", "lang_ext", "body")
    whole = F.forall("pieces", lambda p: p["body"].isNotNull())
    split = (
        texts.where(F.col("part").isNotNull())
        .groupBy(folder(by_folder).alias("folder"), *BOOK_VERSION)
        .agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
        .select(
            F.concat_ws("-", "version", F.col("pieces")[0]["lang_ext"]).alias("series"),
            *BOOK_VERSION,
            F.when(whole, F.array_join(F.col("pieces.body"), "\n")).alias("body"),
        )
    )
    return single.unionByName(split)


def skip_existing(df: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """Drop rows of series that were written by an earlier run, unless `overwrite`."""
    if overwrite:
        return df
    return df.join(existing.select("series").distinct(), "series", "left_anti")


def corpus_log(texts: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """One row per text: 1 if it is (re)written, 0 if an earlier output is kept."""
    done = existing.select("series", F.lit(True).alias("done")).distinct()
    kept = F.lit(False) if overwrite else F.coalesce(F.col("done"), F.lit(False))
    return (
        texts.select("series").distinct()
        .join(done, "series", "left")
        .select(F.col("series").alias("book_id"), F.when(kept, 0).otherwise(1).alias("write_status"))
    )


