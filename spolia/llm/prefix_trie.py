"""Prefix trie of conversations by the Euler-tour technique.

A node is a sequence of turns with which at least one conversation starts; it is known by its depth and 128 bits of
running exclusive-ors of one hash for each (depth, turn), so a conversation of any length is cut into blocks whose
running values are put together, and no task walks it as a whole.  Nodes are sorted by parent and numbered in that
order, so the next number is the next sibling.  Each node gives an arc that enters it and one that leaves it, linked
into the tour of the tree; the tour is ranked by `list_ranking`, and the difference of the sums at a node's two arcs is
the sum over its subtree.  The trie's depth adds no rounds; a node with any number of children is only sorted and joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spolia.llm.common import batch_rows, written
from spolia.llm.list_ranking import LAST, suffix_sums

FAMILY = 100
HEADS = 6
BLOCK = 1024
IDS = 512
_IN_PARTITION = 33  # bits that Spark's growing ids leave for the place in a partition


def numbered(turns: DataFrame) -> DataFrame:
    """`conv_id`, `pos` (from 0), `n_own`, `digest`, `chars` of every turn; rows without conv_id are left out.

    Order: turn, null first; rows with the same turn by the hash of role and text, so repeated rows stand together
    and all stay.  Null role or text counts as empty.  The rows are sorted over all machines, and a turn's place is
    its row less its conversation's first row: a conversation may be longer than a task can hold.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("bigint").alias("chars")
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.select("conv_id", "digest", "chars", F.monotonically_increasing_id().alias("row")), "turns")
    part = F.shiftright("row", _IN_PARTITION)
    counts = sorted(rows.groupBy(part.alias("part")).count().collect())  # a row for each partition
    starts, total = [], 0
    for r in counts:
        starts.append((r["part"], total - (r["part"] << _IN_PARTITION)))
        total += r["count"]
    shift = F.broadcast(turns.sparkSession.createDataFrame(starts, "part bigint, shift bigint"))
    rows = rows.withColumn("part", part).join(shift, "part").select("conv_id", "digest", "chars", (F.col("row") + F.col("shift")).alias("row"))
    firsts = written(rows.groupBy("conv_id").agg(F.min("row").alias("first"), F.count("*").alias("n_own")), "firsts")
    return rows.join(firsts, "conv_id").select("conv_id", (F.col("row") - F.col("first")).alias("pos"), "n_own", "digest", "chars")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: (`conv_id`, `depth` from 1, `n`, `digest`, `chars`) and (`conv_id`, `n`).

    Conversation c starts with the first h turns of conversation c - c % family (all if it has fewer, none if it is
    absent), then has its own turns after its first h; h = crc32 of c in decimal % heads.  `n` is the new length.
    """
    rows = written(numbered(turns), "numbered")
    own = rows.groupBy("conv_id").agg(F.max("n_own").alias("n_own"))
    c = F.col("conv_id")
    convs = own.select("conv_id", "n_own", (F.crc32(c.cast("string")) % heads).alias("h"), (c - c % family).alias("base"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = written(convs.withColumn("n", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).select("conv_id", "base", "h", "taken", "n"), "convs")
    kept = rows.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "n", "digest", "chars")
    first = rows.where(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    inherited = first.join(convs, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "n", "digest", "chars")
    return kept.union(inherited), convs.select("conv_id", "n")


def prefixes(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """`conv_id`, `depth`, `k1`, `k2` (the prefix that ends there), `p1`, `p2` (the one before), `chars`, `ends`."""
    terms = rows.select(
        "conv_id", "depth", F.floor((F.col("depth") - 1) / block).alias("block"), (F.col("depth") == F.col("n")).alias("ends"), "chars",
        F.xxhash64("depth", "digest").alias("t1"), F.xxhash64("digest", "depth").alias("t2"),
    )
    sums = terms.groupBy("conv_id", "block").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = sums.select("conv_id", "block", *[F.bit_xor(f"s{i}").over(before).bitwiseXOR(F.col(f"s{i}")).alias(f"b{i}") for i in (1, 2)])
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = terms.select("*", *[F.bit_xor(f"t{i}").over(inside).alias(f"r{i}") for i in (1, 2)]).join(earlier, ["conv_id", "block"])
    key = [F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    return rows.select(
        "conv_id", "depth", *[key[i - 1].alias(f"k{i}") for i in (1, 2)], *[key[i - 1].bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)], "chars", "ends"
    )


def ends_sha256(rows: DataFrame) -> DataFrame:
    """For each (depth, k1, k2) the SHA-256 of its conversations' numbers, ascending, joined by commas.

    Numbers are put together in blocks of a range of 512, which are hashed one after the other, so no list of all
    conversations that end at a node is ever held.
    """
    key = ["depth", "k1", "k2"]
    block = F.floor(F.col("conv_id") / IDS).alias("block")
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")))
    chunks = rows.groupBy(*key, block).agg(ids.alias("ids"))
    chunks = chunks.repartition(*key).sortWithinPartitions(*key, "block").select(*key, "ids")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for *node, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node != at:
                    out += [(*at, state.hexdigest())] if at else []
                    at, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(out)
        if at:
            yield _batch([(*at, state.hexdigest())])

    with batch_rows(rows.sparkSession, 1000):
        return written(chunks.mapInArrow(hashed, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"), "ends")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["depth", "k1", "k2", "ends_sha256"])


def arcs(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """The tour: `id` (2u enters node u, 2u + 1 leaves it), `prev`, `next`, and the weights `leaves` and `saved`.

    `nodes` are numbered by parent (`u`), `parents` tells of each node with children its first and last child.
    """
    part, u = F.shiftright("u", _IN_PARTITION), F.col("u")
    ends = sorted(nodes.groupBy(part.alias("part")).agg(F.min("u").alias("low"), F.max("u").alias("high")).collect())
    # a row for each partition: its last number, and the numbers next to it in the partitions before and after
    edges = [(r["part"], r["high"], ends[i - 1]["high"] if i else None, ends[i + 1]["low"] if i + 1 < len(ends) else None) for i, r in enumerate(ends)]
    edges = F.broadcast(nodes.sparkSession.createDataFrame(edges, "part bigint, high bigint, prev_high bigint, next_low bigint"))
    above = parents.select("depth", "p1", "p2", F.col("u").alias("parent"), "first", "last")
    own = parents.select("u", F.col("first").alias("first_child"), F.col("last").alias("last_child"))
    rows = nodes.join(above, ["depth", "p1", "p2"], "left").join(own, "u", "left").withColumn("part", part).join(edges, "part")
    place = u.bitwiseAND(F.lit((1 << _IN_PARTITION) - 1))
    before = F.when(u == F.col("first"), None).when(place == 0, F.col("prev_high")).otherwise(u - 1)
    after = F.when(u == F.col("last"), None).when(u == F.col("high"), F.col("next_low")).otherwise(u + 1)
    rows = rows.select("u", "parent", "first_child", "last_child", "saved", F.when(F.col("parent").isNotNull(), before).alias("before"), F.when(F.col("parent").isNotNull(), after).alias("after"))

    def enter(c: str) -> Column:
        return F.col(c) * 2

    def leave(c: str) -> Column:
        return F.col(c) * 2 + 1

    down = F.struct(
        enter("u").alias("id"), F.coalesce(leave("before"), enter("parent")).alias("prev"), F.coalesce(enter("first_child"), leave("u")).alias("next"),
        F.col("first_child").isNull().cast("bigint").alias("leaves"), "saved",
    )
    up = F.struct(
        leave("u").alias("id"), F.coalesce(leave("last_child"), enter("u")).alias("prev"), F.coalesce(enter("after"), leave("parent")).alias("next"),
        F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"),
    )
    return rows.select(F.explode(F.array(down, up)).alias("arc")).select("arc.*")


def trie(turns: DataFrame, family: int = FAMILY, heads: int = HEADS, block: int = BLOCK, last: int = LAST) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see `rebuilt`), the root included.

    `conv_id` (smallest member), `depth`, `parent_conv_id` (null for the root), `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens` (over the subtree: each node's members but one times the code points of its last text), and
    `ends_sha256` of the members that end there.  An empty table has no node; other columns are ignored.
    """
    rows, convs = rebuilt(turns, family, heads)
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("chars"), (F.col("n") == 0).alias("ends"))
    rows = written(prefixes(rows, block).union(roots), "prefixes")
    ends = ends_sha256(rows.where("ends").select("conv_id", "depth", "k1", "k2"))
    nodes = rows.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("chars").alias("chars")
    )
    order = ["depth", "p1", "p2", "k1", "k2"]
    nodes = nodes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("u", F.monotonically_increasing_id())
    nodes = written(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).drop("chars"), "nodes")
    children = nodes.where("depth > 0").groupBy("depth", "p1", "p2").agg(F.min("u").alias("first"), F.max("u").alias("last"), F.count("*").alias("n_children"))
    named = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), "u", F.col("conv_id").alias("parent_conv_id"))
    parents = written(children.join(named, ["depth", "p1", "p2"]), "parents")
    sums = suffix_sums(arcs(nodes, parents), ["leaves", "saved"], last)
    sign = F.when(F.col("id") % 2 == 0, 1).otherwise(-1)
    inside = sums.groupBy(F.shiftright("id", 1).alias("u")).agg(F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens"))
    out = nodes.join(inside, "u").join(parents.select("u", "n_children"), "u", "left").join(ends, ["depth", "k1", "k2"], "left")
    out = out.join(parents.select("depth", "p1", "p2", "parent_conv_id"), ["depth", "p1", "p2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
