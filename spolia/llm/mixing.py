"""Mixing sources to target weights by systematic sampling.

Per source, the expected number of copies of a document is target / size of the source.  Documents of a source
are laid end to end, each as long as its expected copies; one random offset per source shifts the line, and
a document is emitted once for every integer boundary that it crosses.  The prefix sum runs in two levels
(within blocks, then over block totals; at most BLOCKS blocks a source), so a source with a third of all rows
still spreads over many tasks.  Blocks follow the order of size, which keeps the taken words near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spolia.llm.common import DOCUMENT_COLUMNS, WORD, filled, written

WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
MOST_COPIES = 3  # a target stops at so many times its source's size
SALTS = 64  # blocks of one size class
SIZE_CLASSES = 256
SEED = 20240229


def words(text: str | Column = "text") -> Column:
    """Number of words; 0 for null."""
    return F.regexp_count(filled(text), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """`source`, `source_size`, `target` from `source`, `source_size` (one row per source, null last).

    All sizes are shared out by weight; what exceeds `most` times a source's size is shared again among the
    others until no target is above.  Sources reach their bound in the order of bound / weight, so the bounded
    ones are a prefix of that order and running sums find it at once.  A source without words gets 0.
    """
    number = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.get(choices, (F.row_number().over(number) - 1) % len(weights)))
    rows = rows.withColumn("bound", (F.col("source_size") * most).cast("double"))
    by_ratio = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    shared = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("bounded", F.col("bound") <= F.col("weight") * left / shared)
    free_words = F.sum("source_size").over(whole) - F.sum(F.when(F.col("bounded"), F.col("bound")).otherwise(0.0)).over(whole)
    free_weight = F.sum(F.when(F.col("bounded"), 0.0).otherwise(F.col("weight"))).over(whole)
    share = F.when(F.col("bounded"), F.col("bound")).otherwise(F.try_divide(F.col("weight") * free_words, free_weight))
    return rows.select("source", "source_size", share.alias("target"))


def row_mark(df: DataFrame) -> Column:
    """Hash of those columns of documents that are there."""
    return F.xxhash64(*[c for c in DOCUMENT_COLUMNS if c in df.columns])


def mixed(df: DataFrame, key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns `keep`, and `mark`, `size`, `source_size`, `target`, `copies` of every row.

    Null text has size 0; a null source is a source of its own; repeated rows are sampled each; documents
    without words are never taken; an empty table gives an empty result.  Texts are read once, for their sizes and hashes
    (`mark`, of all columns of documents, which settles ties too); the narrow rows are written and sampled.
    """
    carried = [F.col(c).alias(f"kept_{k}") for k, c in enumerate(keep)]
    rows = df.select(*carried, F.col("source").alias("source"), F.col(key).alias("key"), words().alias("size"), row_mark(df).alias("mark"))
    rows = written(rows, "sizes")
    size_class = F.least(F.lit(SIZE_CLASSES - 1), F.floor(8 * F.log2(F.col("size") + 1.0))).cast("int")
    rows = rows.withColumns({"class": size_class, "salt": F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")})
    block = ["source", "class", "salt"]
    rows = rows.repartition(*block)

    blocks = rows.groupBy(*block).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    sources = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")))
    line = Window.partitionBy("source").orderBy("class", "salt").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(line), F.lit(0)))
    blocks = blocks.withColumnsRenamed({c: f"of_{c}" for c in block}).join(
        sources.withColumnRenamed("source", "name"), F.col("of_source").eqNullSafe(F.col("name"))
    )
    within = Window.partitionBy(*block).orderBy("size", "key", "mark")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1)
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in block]
    joined = ranked.join(blocks, same)

    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), F.lit(SEED)), F.lit(1 << 52)) / float(1 << 52)
    place = F.col("before") + F.col("rank")
    crossed = F.floor(offset + each * (place + 1)) - F.floor(offset + each * place)
    copies = F.when(F.col("size") > 0, F.least(crossed, F.lit(MOST_COPIES))).otherwise(0).cast("bigint")
    names = [F.col(f"kept_{k}").alias(c) for k, c in enumerate(keep)]
    return joined.select(*names, "mark", "size", "source_size", "target", copies.alias("copies"))


def taken(df: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes of it."""
    rows = mixed(df, keep=("doc_id",))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(df: DataFrame) -> DataFrame:
    """The documents, each as often as the mix takes it.

    The sample is drawn on narrow rows; the texts go through one shuffle, where they meet their copies.  Repeated rows,
    which nothing tells apart, meet the sum of theirs.
    """
    rows = df.select(*DOCUMENT_COLUMNS)
    drawn = mixed(rows, keep=("doc_id",)).where("copies > 0").groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("of_mark"))
    drawn = drawn.agg(F.sum("copies").cast("int").alias("copies"))
    rows = rows.withColumn("mark", row_mark(df)).dropDuplicates(["doc_id", "mark"])
    rows = rows.join(drawn, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")))
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return rows.withColumn("copy", again).select(*DOCUMENT_COLUMNS)
