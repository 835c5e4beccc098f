"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    That is spark.checkpoint.dir; only where it is unset (tests) a temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="spolia-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, most_rows: int | None = None, codec: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read back: later plans start from the files, of at most `most_rows` if given.

    Nothing reads the write's own shuffles again, so their files go at its end, not when the driver happens to collect garbage.
    """
    path = shared_folder(df.sparkSession, name)
    writer = df.write.option("maxRecordsPerFile", most_rows) if most_rows else df.write
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        writer.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes the folders of tables from `written` that no later plan reads."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Another value of a setting; holds for actions inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def batch_rows(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """Fewer rows in an Arrow batch, for jobs whose rows are large; holds for actions inside the block."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most about `most_bytes` of text (at least one row each)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = np.nan_to_num(column_lengths(column))
        piece = ((np.cumsum(lengths) - 1) // most_bytes).clip(min=0)
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def column_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each value, 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a string or binary array one after the other, and n + 1 offsets; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_arrow(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text", most_bytes: int = 4 << 20
) -> DataFrame:
    """mapInArrow in pieces of bounded size; `work` turns one piece into one batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text, most_bytes):
            yield work(piece)

    return df.mapInArrow(each, schema)
