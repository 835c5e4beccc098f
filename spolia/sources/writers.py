"""Sinks.  All of them write from the executors and overwrite their target."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from spolia import config, schemas
from spolia.functions.cells import escaped_cells
from spolia.operators.alignments import PLACE, placed
from spolia.operators.records import with_chunk

# Fixed value: options of a tab-separated file that keeps every character of a text.
TSV = dict(
    sep="\t", header=True, quote='"', escape='"',
    ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
)

ESCAPED = "tsv"  # ending of files whose cells are escaped


def write_milestoned(files: DataFrame, path: str, fmt: str = "text") -> None:
    """Complete tagged files (`file_name, value`).

    `text` gives one file per text in a directory `file_name=...`; `parquet` keeps many
    texts per file and is the better choice for a large corpus.
    """
    writer = files.select("file_name", "value").write.mode("overwrite")
    if fmt == "text":
        writer.partitionBy("file_name").option("lineSep", "\n").text(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def write_records(
    records: DataFrame,
    path: str,
    rows: int = config.CHUNK_ROWS,
    per_series: bool = True,
) -> None:
    """Records as JSON lines.

    With `per_series` a directory `file=<series>-<chunk>` holds one file of at most `rows`
    records; the chunk number keeps the parts of a long series apart, so no task receives
    a whole one; only the files of the given records are replaced.  Without it the records are added, sorted by series
    and place, in files of bounded size next to those of earlier runs (`existing_series` reads their series), for corpora with
    more series than a file system should have directories.
    """
    if not per_series:
        ordered = records.repartitionByRange("series", "pos").sortWithinPartitions("series", "pos").drop("pos")
        ordered.write.mode("append").option("maxRecordsPerFile", 1000 * rows).json(path)
        return
    (
        with_chunk(records, rows)
        .withColumn("file", F.concat_ws("-", "series", "chunk"))
        .repartition("file")
        .sortWithinPartitions("file", "pos")
        .drop("pos", "chunk")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file")
        .json(path)
    )


def write_pairwise(df: DataFrame, path: str, escape: bool = True, is_placed: bool = False) -> None:
    """One directory per book pair with its alignments, sorted by `id1, id2` (ties by place).

    Rows are dealt out by sampled ranges of pair and place, so a frequent pair is spread over several tasks and its
    files, in the order of their names, follow each other without overlap; small pairs share a task.  There are as many
    ranges as `spark.sql.shuffle.partitions` says, less where adaptive execution puts small ones together.  Line breaks in
    cells are escaped (`functions.cells`), so that each row is one line and readers can split a file; such files end in
    `.tsv`.  Without `escape` line breaks are quoted, for programs that expect that, and files end in `.csv`.
    Rows of `alignments.placed` are dealt out already (`is_placed`) and only sorted.
    """
    columns = [c for c in schemas.PAIRWISE_COLUMNS if c in df.columns]
    others = [c for c in df.columns if c not in columns and c not in ("series1", "series2")]
    rows = df.select(*columns, *others, "series1", "series2")
    rows = (rows if is_placed else placed(rows)).sortWithinPartitions(*[c for c in PLACE if c in df.columns])
    if escape:
        rows = escaped_cells(rows, [*columns, *others])
    options = TSV | ({"extension": ESCAPED} if escape else {})
    rows.write.mode("overwrite").partitionBy("series1", "series2").options(**options).csv(path)


def write_book_stats(stats: DataFrame, path: str, single_file: bool = False) -> None:
    """Gzipped TSV ordered by `_T1, _T2`.

    The order is global over the files.  `single_file` puts them together as members of one gzip file, which readers
    take as one: the rows are still sorted and compressed by many tasks, and only bytes are copied.
    """
    ordered = stats.repartitionByRange("_T1", "_T2").sortWithinPartitions("_T1", "_T2")
    options = TSV | {"compression": "gzip"}
    if not single_file:
        ordered.write.mode("overwrite").options(**options).csv(path)
        return
    spark, parts = stats.sparkSession, f"{path.rstrip('/')}-members-{uuid.uuid4().hex}"
    header = spark.createDataFrame([tuple(stats.columns)], ", ".join(f"`{c}` string" for c in stats.columns))
    header.coalesce(1).write.options(**options | {"header": False}).csv(f"{parts}/header")
    ordered.write.options(**options | {"header": False}).csv(f"{parts}/rows")
    join_files(spark, [f"{parts}/header", f"{parts}/rows"], f"{path.rstrip('/')}/part-00000.csv.gz")


def join_files(spark: SparkSession, folders: list[str], target: str) -> None:
    """The part files of the folders, in order, as one file; the folders are removed, other files beside it too.

    Bytes are copied through a buffer, on whatever file system Spark writes to.
    """
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    goal = hadoop.fs.Path(target)
    fs = goal.getFileSystem(conf)
    fs.delete(goal.getParent(), True)
    out = fs.create(goal, True)
    try:
        for folder in folders:
            found = fs.globStatus(hadoop.fs.Path(f"{folder}/part-*"))
            for name in sorted(status.getPath().toString() for status in found):
                part = fs.open(hadoop.fs.Path(name))
                hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                part.close()
    finally:
        out.close()
    for folder in folders:
        fs.delete(hadoop.fs.Path(folder).getParent(), True)


def write_log(log: DataFrame, path: str) -> None:
    """Corpus log `book_id, write_status` as CSV with header."""
    log.write.mode("overwrite").csv(path, header=True)
