"""Engine inputs built from the driver tables.

Every builder runs over its whole tables and whole texts.  Documents play two roles: as
files of a corpus (names, parts and extensions follow from `doc_id`), and as milestones of
books (one book per `source`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from spolia import config
from spolia.functions import align
from spolia.functions.uri import with_uri
from spolia.operators.once import computed_once, exploded

TOKEN_CLASS = r"\p{L}"
MS_LEN = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt out to all cores if their files give fewer partitions than that.

    A table of many files is used as it is scanned.
    """
    docs, cores = table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def _file_name() -> Column:
    version = F.expr("doc_id div 4")
    number = version.cast("string")
    letter = F.when(F.expr("doc_id % 4 < 2"), "A").otherwise("B")
    extension = (
        F.when(F.expr("doc_id % 4 = 0"), "")
        .when(F.expr("doc_id % 4 = 1"), ".inProgress")
        .when(F.expr("doc_id % 4 = 2"), ".completed")
        .otherwise(".mARkdown")
    )
    split_book = version % 5 == 0
    return F.concat(
        F.lpad((version % 1000).cast("string"), 4, "0"),
        F.lit("src"), (version % 20).cast("string"),
        F.lit(".T"), (version % 7).cast("string"),
        F.lit(".D"), number,
        F.when(split_book, letter).otherwise(""),
        F.lit("-eng1"),
        F.when(split_book, F.when(F.expr("doc_id % 2 = 0"), "").otherwise(".mARkdown")).otherwise(extension),
    )


def file_value(body: Column) -> Column:
    return F.concat(F.lit(f"######Text#\n\n{config.SPLITTER}\n\n"), body, F.lit("\n"))


def corpus_files(spark: SparkSession, sf_dir: str, body: Column | None = None) -> DataFrame:
    """Documents as files: four extensions of one version, or two parts with two extensions.

    `body` is what a file holds below its header, the text of the document by default.
    """
    docs = documents(spark, sf_dir)
    return with_uri(
        docs.select(_file_name().alias("file_name"), "doc_id", F.col("lang").alias("doc_lang"),
                    file_value(F.col("text") if body is None else body).alias("value"))
    )


def tagged_text(text: Column) -> Column:
    """A text with an old tag at the end of every line and white space after the last."""
    return F.concat(F.replace(text, F.lit("\n"), F.lit(" ms12\n")), F.lit("  msA013 \n\t"))


def overlapping_tags(text: Column) -> Column:
    """A text with, at the end of every line, a tag that leaves another one when removed."""
    return F.replace(text, F.lit("\n"), F.lit(" mms12s34\n"))


def version_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per version: primary if any of its documents is labelled of good quality."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) == 1
    return (
        docs.select("doc_id").join(labels.select("doc_id", "quality"), "doc_id", "left")
        .groupBy(F.expr("doc_id div 4").alias("v"))
        .agg(F.when(good, "pri").otherwise("sec").alias("status"))
        .select(F.concat(F.lit("D"), "v").alias("id"), "status")
    )


def earlier_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that an earlier run wrote: those of labelled documents without extension."""
    files = corpus_files(spark, sf_dir).where("ext is null and part is null").select("doc_id", "series")
    return files.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("series")


def series_of(source: Column) -> Column:
    return F.concat(F.lit("S"), source, F.lit("-eng1"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the milestones of one book per source."""
    seq = F.col("doc_id") + 1
    return documents(spark, sf_dir).select(
        F.concat(series_of(F.col("source")), F.lit(".ms"), seq.cast("string")).alias("id"),
        series_of(F.col("source")).alias("series"),
        "text",
        seq.alias("seq"),
    )


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def book_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source; every seventh date is no number, every ninth length is missing."""
    n = F.substring("source", 4, 9).cast("int")
    return (
        documents(spark, sf_dir)
        .groupBy("source")
        .agg(
            F.sum(_blanks(F.col("text")) + 1).alias("tokens"), F.sum(F.length("text")).alias("chars")
        )
        .select(
            F.concat(F.lit("S"), "source").alias("id"),
            F.lit("pri").alias("status"),
            F.when(n % 9 != 8, F.col("tokens").cast("string")).alias("tok_length"),
            F.col("chars").cast("string").alias("char_length"),
            F.when(n % 7 == 6, "unknown").otherwise((n % 7).cast("string")).alias("date"),
            F.concat(F.lit("A"), (n % 4).cast("string")).alias("author_lat"),
            F.concat(F.lit("B"), n.cast("string")).alias("book"),
        )
    )


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned passages: copies against the first document of another source with the same first line.

    A document is linked to one partner only, so the links grow with the documents and not
    with the square of a group of copies.  Both texts are cut into lines, and line k is
    set against line k, padded with gaps to equal length; lines beyond the end of the shorter
    text stand against gaps only, so no character is left out.  The side with the smaller
    source comes first.
    """
    docs = documents(spark, sf_dir).withColumn("first_line", F.substring_index("text", "\n", 1))
    least = docs.groupBy("first_line").agg(F.min(F.struct("doc_id", "source")).alias("a"))
    grouped = docs.select("doc_id", "source", "first_line").join(least, "first_line")
    other = grouped.where("source <> a.source").groupBy("first_line").agg(F.min("doc_id").alias("b"))
    partner = F.when(F.col("source") != F.col("a.source"), F.col("a.doc_id")).when(F.col("doc_id") != F.col("a.doc_id"), F.col("b"))
    copies = grouped.join(other, "first_line").select("doc_id", partner.alias("partner")).where("partner is not null")
    sides = ("doc_id", "source", "text")
    whole = docs.select(*sides)
    pairs = (
        copies.join(whole, "doc_id")
        .join(whole.select(*[F.col(c).alias(f"p_{c}") for c in sides]), F.col("partner") == F.col("p_doc_id"))
    )
    own_first = F.col("source") < F.col("p_source")
    ordered = pairs.select(
        *[F.when(own_first, F.col(c)).otherwise(F.col(f"p_{c}")).alias(f"{c}1") for c in sides],
        *[F.when(own_first, F.col(f"p_{c}")).otherwise(F.col(c)).alias(f"{c}2") for c in sides],
    )
    # Everything that looks at a whole text is computed before the text is cut into rows.
    line = F.lit("[^\n]*+\n|[^\n]++")
    heads = ordered.select(
        *[F.col(f"{c}{s}") for c in ("doc_id", "source") for s in (1, 2)],
        *[F.length(f"text{s}").alias(f"len{s}") for s in (1, 2)],
        *[(_blanks(F.col(f"text{s}")) + 1).alias(f"tok{s}") for s in (1, 2)],
        F.arrays_zip(
            F.regexp_extract_all("text1", line, 0).alias("t1"), F.regexp_extract_all("text2", line, 0).alias("t2")
        ).alias("lines"),
    )
    kept = [c for c in heads.columns if c != "lines"]
    lines = (
        exploded(heads, kept, "lines", "k", "t")
        .select(*kept, "k", *[F.coalesce(f"t.t{s}", F.lit("")).alias(f"t{s}") for s in (1, 2)])
    )
    # Lines of one pair of texts; the longer text bounds the group.
    earlier = (
        Window.partitionBy("doc_id1", "doc_id2").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    )
    width = F.greatest(F.length("t1"), F.length("t2"))
    placed = lines.withColumns(
        {f"c{s}": F.coalesce(F.sum(F.length(f"t{s}")).over(earlier), F.lit(0)).cast("int") for s in (1, 2)}
        | {f"w{s}": F.coalesce(F.sum(_blanks(F.col(f"t{s}"))).over(earlier), F.lit(0)).cast("int") for s in (1, 2)}
        | {f"s{s}": F.rpad(f"t{s}", width, F.lit("-")) for s in (1, 2)}
    )
    # Compared in Arrow batches: where rows are dealt out by sampled ranges, all of this runs twice.
    placed = placed.withColumn("matches", align.counts(F.col("s1"), F.col("s2"))["ch_all"])
    columns = {}
    for s in (1, 2):
        text, doc_id, series = F.col(f"t{s}"), F.col(f"doc_id{s}"), series_of(F.col(f"source{s}"))
        columns |= {
            f"b{s}": F.col(f"c{s}"),
            f"e{s}": F.col(f"c{s}") + F.length(text),
            f"bw{s}": F.col(f"w{s}"),
            f"ew{s}": F.col(f"w{s}") + _blanks(text) + 1,
            f"first{s}": doc_id,
            f"gid{s}": F.substring(f"source{s}", 4, 9).cast("bigint"),
            f"uid{s}": doc_id,
            f"id{s}": F.concat(series, F.lit(".ms"), (doc_id + 1).cast("string")),
            f"len{s}": F.col(f"len{s}"),
            f"tok{s}": F.col(f"tok{s}"),
            f"seq{s}": (doc_id + 1).cast("int"),
            f"series{s}": series,
            f"s{s}": F.col(f"s{s}"),
        }
    # Computed once: the statistics filter and join on many of these columns.
    return computed_once(placed, columns).select(
        *columns, "matches", (F.col("matches") / F.length("s1")).alias("score")
    )


def raw_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments as an aligner may leave them: blank lines without score, some rows twice."""
    blank = F.trim(F.replace("s1", F.lit("\n"), F.lit(" "))) == ""
    copies = F.sequence(F.lit(1), F.when(F.col("uid1") > F.col("uid2"), 2).otherwise(1))
    df = alignments(spark, sf_dir).withColumn("score", F.when(~blank, F.col("score")))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")
