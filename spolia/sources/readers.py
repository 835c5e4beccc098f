"""Sources."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from spolia import config, schemas
from spolia.functions.cells import unescaped_cells
from spolia.functions.uri import with_uri
from spolia.operators.once import computed_once
from spolia.sources.writers import ESCAPED


def read_texts(spark: SparkSession, path: str, name_regex: str = config.FILE_NAME) -> DataFrame:
    """One row per text file below `path`: `file_name, path, value` and the URI columns.

    The name test is on file metadata, so other files are pruned before they are opened.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    named = files.where(F.col("_metadata.file_name").rlike(name_regex)).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"), "value"
    )
    return with_uri(named)


def read_text_ranges(
    spark: SparkSession, path: str, name_regex: str = config.FILE_NAME, chars: int = 1 << 20, exact: bool = False
) -> DataFrame:
    """The files of `read_texts` in many rows: `file_name, path, pos, piece`; in order of `pos` the pieces are the file.

    Spark's line reader deals out one file by byte ranges, so a file of any size is read by many tasks, from any store
    Spark reads.  A piece is some lines of one byte range, about `chars` characters; a single line must fit in a task.
    `pos` is the place of the byte range and the piece's number in it (fewer pieces than bytes, so ranges stay
    apart).  Every piece ends with a line break; with `exact` one that the file does not end with is taken away.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    named = files.where(F.col("_metadata.file_name").rlike(name_regex)).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"), "value",
    )
    pieces = named.mapInArrow(partial(_joined_lines, chars), "file_name string, path string, size bigint, pos bigint, piece string")
    if exact:
        ends = pieces.groupBy("path").agg(F.max("pos").alias("pos"), F.sum(F.octet_length("piece")).alias("_bytes"))
        cut = F.col("_bytes") > F.col("size")
        pieces = pieces.join(ends, ["path", "pos"], "left").withColumn(
            "piece", F.when(cut, F.expr("left(piece, length(piece) - 1)")).otherwise(F.col("piece"))
        )
    return with_uri(pieces.select("file_name", "path", "pos", "piece"))


def _joined_lines(chars: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together; the lines of a byte range come one after the other."""
    at, number = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, starts = batch.column("path").to_pylist(), batch.column("start").to_pylist()
        size = pc.fill_null(pc.binary_length(batch.column("value")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        filled = np.cumsum(size) // chars
        cuts = [0, *(k for k in range(1, len(paths)) if filled[k] != filled[k - 1] or starts[k] != starts[k - 1] or paths[k] != paths[k - 1]), len(paths)]
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), batch.column("value"))
        pieces = pc.binary_join_element_wise(pc.binary_join(lists, "\n"), "", "\n")
        pos = []
        for k in cuts[:-1]:
            key = paths[k], starts[k]
            number = number + 1 if key == at else 0
            at = key
            pos.append(starts[k] + number)
        first = batch.take(pa.array(cuts[:-1]))
        columns = [first.column("file_name"), first.column("path"), first.column("size"), pa.array(pos, pa.int64()), pieces]
        yield pa.record_batch(columns, ["file_name", "path", "size", "pos", "piece"])


def list_texts(spark: SparkSession, path: str, name_regex: str = config.FILE_NAME) -> DataFrame:
    """The files of `read_texts` without their content, which is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = files.select(F.substring_index("path", "/", -1).alias("file_name"), "path", "length")
    return with_uri(named.where(F.col("file_name").rlike(name_regex)))


def read_metadata(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Tab-separated metadata with a header line, every column as string.

    The columns present are taken from the header; those of `schemas.METADATA` that are
    missing are added as nulls.
    """
    df = spark.read.csv(path, sep="\t", header=True)
    missing = {f.name: F.lit(None).cast("string") for f in schemas.METADATA if f.name not in df.columns}
    if "id" in missing:
        raise ValueError(f"metadata {path} has no column 'id'")
    return df.withColumns(missing) if missing else df


def read_milestoned(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """Tagged files written by `writers.write_milestoned`, as `read_texts` returns files."""
    files = spark.read.parquet(path) if fmt == "parquet" else spark.read.text(path, wholetext=True)
    return with_uri(files.select("file_name", "value"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Milestone records from JSON lines, flat or in one directory per chunk."""
    return spark.read.schema(schemas.RECORDS).json(path).select(schemas.RECORDS.names)


def _format_of(path: str) -> str:
    suffix = path.rstrip("/").rsplit(".", 1)[-1]
    if suffix not in ("json", "parquet", "csv", ESCAPED):
        raise ValueError(f"cannot tell the format of {path}; pass fmt")
    return suffix


def _json_columns(spark: SparkSession, path: str) -> list[str]:
    """Names that occur in a JSON dataset (one pass over it, a small result)."""
    keys = F.explode(F.json_object_keys("value")).alias("key")
    found = spark.read.text(path).select(keys).distinct().orderBy("key").collect()
    return [row["key"] for row in found]


def _fitted(raw: DataFrame) -> DataFrame:
    """Columns of strings in their types, and `_misfit`: names of the columns whose value does not fit, null if none.

    Behind a generator: a filter on `_misfit` that is pushed into the projection names every column's expression, and
    the optimizer would then state it anew for each subset of the columns.
    """
    columns, failed = {}, []
    for field in schemas.typed_schema(raw.columns).fields:
        name, kind = field.name, field.dataType.simpleString()
        value = F.col(name)
        if kind in ("int", "bigint"):  # whole numbers may be written with a decimal point
            number = value.try_cast("decimal(38,6)")
            value = F.when(number == F.floor(number), number.try_cast(kind))
        elif kind != "string":
            value = value.try_cast(kind)
        columns[name] = value
        failed.append(F.when(F.col(name).isNotNull() & value.isNull(), name))
    return computed_once(raw, columns | {"_misfit": F.nullif(F.concat_ws(",", *failed), F.lit(""))})


def read_alignments(
    spark: SparkSession, path: str, fmt: str | None = None, columns: list[str] | None = None, misfits: bool = False
) -> DataFrame:
    """Alignments as JSON lines, Parquet, TSV with header (`csv`, or `tsv` with escaped cells), or, where `columns` names them,
    comma-separated files without header (`csv`); the format is taken from the path suffix.

    The schema covers the columns that are really there: a column absent from the whole
    dataset must not read as null, since rows with nulls are dropped later.  For JSON this
    takes a pass over the data unless `columns` names them.  A JSON value that does not fit its column's type reads as
    null; with `misfits` a column `_misfit` tells such rows from those that had a null.
    """
    fmt = fmt or _format_of(path)
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "json":
        names = columns or _json_columns(spark, path)
        df = _fitted(spark.read.schema(", ".join(f"`{n}` string" for n in names)).json(path))
        df = df if misfits else df.drop("_misfit")
    elif fmt == "csv":
        df = read_plain_csv(spark, path, columns) if columns else read_tsv(spark, path)
    elif fmt == ESCAPED:
        df = read_tsv(spark, path, escaped=True)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    absent = [c for c in schemas.ALIGNMENT_REQUIRED if c not in df.columns]
    if absent:
        raise ValueError(f"alignments {path} lack {', '.join(absent)}")
    return df


def read_tsv(spark: SparkSession, path: str, escaped: bool = False, names: str = "*") -> DataFrame:
    """Tab-separated files with header; known columns get their type, others are strings.  `names` limits the file names.

    A quoted empty field is an empty string; the null marker only has to differ from it.  With `escaped` every row is
    one line and Spark splits large files; otherwise cells may hold quoted line breaks, so a file is read as one piece.
    """
    reader = spark.read.options(
        sep="\t", header=True, multiLine=not escaped, quote='"', escape='"', nullValue=r"\N", pathGlobFilter=names
    )
    columns = reader.csv(path).columns
    df = reader.schema(schemas.typed_schema(columns)).csv(path)
    return unescaped_cells(df, [c for c in columns if c not in ("series1", "series2")]) if escaped else df


def read_plain_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Comma-separated files without header, as Spark writes them by default, with the given column names."""
    return spark.read.options(multiLine=True).schema(schemas.typed_schema(columns)).csv(path)


def read_pairwise(spark: SparkSession, path: str) -> DataFrame:
    """Pairwise tables written by `writers.write_pairwise`, with escaped cells or not (hidden files are ignored)."""
    found = []
    for ending in (ESCAPED, "csv"):
        try:
            found.append(read_tsv(spark, path, ending == ESCAPED, f"*.{ending}*"))
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # raised where no file has this ending
                raise
    if not found:
        raise ValueError(f"no pairwise table in {path}")
    return reduce(DataFrame.unionByName, found)


def existing_series(spark: SparkSession, path: str) -> DataFrame:
    """Series that already have output below `path`: from directory names, or from the records of flat files."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException:  # nothing written yet
        return spark.createDataFrame([], "series string")
    series = F.regexp_extract("path", "/file=([^/]+)-[0-9]{5,}/", 1)
    named = files.select(F.url_decode(series).alias("series")).where("series <> ''").distinct()
    if not named.isEmpty() or files.isEmpty():
        return named
    return spark.read.schema("series string").json(path).where("series is not null").distinct()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Corpus log, `book_id, write_status`."""
    return spark.read.csv(path, header=True, schema="book_id string, write_status int")
