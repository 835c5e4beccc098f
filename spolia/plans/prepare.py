"""Texts to milestoned texts, and texts to milestone records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spolia import config
from spolia.operators import corpus, milestones as ms, ranges as rg, records as rec
from spolia.sources import readers, writers


def milestone_texts(
    texts: DataFrame,
    ms_len: int = config.MS_LEN,
    token_class: str = config.TOKEN_CLASS,
    ms_regex: str | None = config.MS_TAG_SPACED,
    splitter: str | None = config.SPLITTER,
    max_residual: int = 1,
    by_folder: bool = False,
) -> DataFrame:
    """Cut, check, number and tag texts; unsound ones carry a `reason`."""
    cut = ms.assign_milestones(ms.prepare_texts(texts, ms_regex, splitter), ms_len, token_class)
    checked = ms.check_milestones(cut, ms_regex or config.MS_TAG_FALLBACK, max_residual)
    return ms.rebuild_text(ms.continue_numbering(checked, texts.drop("value"), by_folder))


def insert_milestones(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    ms_len: int = config.MS_LEN,
    token_class: str = config.TOKEN_CLASS,
    fmt: str = "text",
    name_regex: str = config.FILE_NAME_LOWER_LANG,
    rejects_path: str | None = None,
    by_folder: bool = False,
) -> DataFrame:
    """Write the milestoned form of every text below `in_path`; returns the rejected files.

    The rejects are written to `rejects_path` (default: `out_path` with "-rejects") and read back.  The texts below
    `in_path` are left untouched.
    """
    texts = readers.read_texts(spark, in_path, name_regex)
    sound, rejects = ms.split_rejects(milestone_texts(texts, ms_len, token_class, by_folder=by_folder))
    writers.write_milestoned(ms.milestoned_files(sound), out_path, fmt)
    return _rejected(rejects, rejects_path or f"{out_path.rstrip('/')}-rejects")


def _rejected(rejects: DataFrame, path: str) -> DataFrame:
    rejects.write.mode("overwrite").parquet(path)
    return rejects.sparkSession.read.schema(rejects.schema).parquet(path)


def select_texts(
    texts: DataFrame,
    metadata: DataFrame | None,
    settings: config.CorpusConfig,
    listing: DataFrame | None = None,
) -> DataFrame:
    """Primary filter, best version, header cut, parts merged: one row per text.

    The choice is made on `listing`, the same files without content where that is cheaper
    to read; the texts follow in one join.
    """
    names = texts.drop("value") if listing is None else listing
    if settings.primary_only:
        names = corpus.filter_primary(names, metadata)
    chosen = corpus.select_version(texts, names, settings.by_folder)
    return corpus.merge_parts(corpus.with_body(chosen, settings.splitter), settings.by_folder).where("body is not null")


def text_records(texts: DataFrame, settings: config.CorpusConfig) -> DataFrame:
    """Records of selected texts."""
    return rec.to_records(
        rec.explode_milestones(texts, settings.ms_regex), settings.include_book_uri, fold=settings.fold
    )


def export_records(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    log_path: str,
    metadata_path: str | None = None,
    settings: config.CorpusConfig = config.CorpusConfig(),
    rejects_path: str | None = None,
    per_series: bool = True,
) -> DataFrame:
    """Write the records of all selected texts that have none yet; returns the corpus log.

    Files that cannot be used go to `rejects_path` (default: `log_path` with "-rejects") as `path, file_name, reason`;
    the log names the usable ones and is written before the records: it tells what was there before this run.
    `per_series=False` adds the records to one table of files for corpora of very many series.
    """
    metadata = readers.read_metadata(spark, metadata_path) if settings.primary_only else None
    listing = readers.list_texts(spark, in_path, settings.file_name_regex)
    if settings.primary_only:
        listing = corpus.filter_primary(listing, metadata)
    chosen = corpus.chosen_versions(listing, settings.by_folder)
    texts = readers.read_texts(spark, in_path, settings.file_name_regex).join(chosen, "path", "left_semi")
    reasons = corpus.with_reason(texts, settings.splitter, settings.by_folder).where("reason is not null").select("path", "file_name", "reason")
    reasons = reasons.unionByName(corpus.same_names(listing, chosen))
    rejects = _rejected(reasons, rejects_path or f"{log_path.rstrip('/')}-rejects").select("path")

    usable = listing.join(chosen, "path", "left_semi").join(rejects, "path", "left_anti")
    names = corpus.merge_parts(usable.withColumn("body", F.lit("")), settings.by_folder)
    existing = readers.existing_series(spark, out_path)
    writers.write_log(corpus.corpus_log(names, existing, settings.overwrite), log_path)
    sound = corpus.with_body(texts.join(rejects, "path", "left_anti"), settings.splitter)
    todo = corpus.skip_existing(corpus.merge_parts(sound, settings.by_folder), existing, settings.overwrite)
    writers.write_records(text_records(todo, settings), out_path, settings.chunk_rows, per_series)
    return readers.read_log(spark, log_path)


def milestone_ranges(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    ms_len: int = config.MS_LEN,
    token_class: str = config.TOKEN_CLASS,
    name_regex: str = config.FILE_NAME_LOWER_LANG,
    ms_regex: str | None = config.MS_TAG_SPACED,
    splitter: str | None = config.SPLITTER,
) -> DataFrame:
    """Tagged bodies of texts of any length as Parquet rows `file_name, pos, piece`; returns them read back.

    For corpora with books that no task can hold: files are read, cut and tagged in ranges (`operators.ranges`) and never
    put together.  Every file is numbered on its own, so books split into parts belong in `insert_milestones`.
    """
    lines = readers.read_text_ranges(spark, in_path, name_regex).select("file_name", "pos", "piece")
    ranges = rg.strip_tags(rg.body_ranges(lines, splitter), ms_regex)
    tagged = rg.tagged_ranges(ranges, ms_len, token_class)
    tagged.sortWithinPartitions("file_name", "pos").write.mode("overwrite").parquet(out_path)
    return spark.read.schema(tagged.schema).parquet(out_path)
