"""Statistics per book pair.

Order of work: compare the passages (map side, leaving one bit per character), attach
milestone offsets, shift the bits to their places, unite them per pair, and only then
look up metadata.  No step gathers the positions of a pair in one place: a pair is spread
over its 64-position words and reunited as counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spolia import config, schemas
from spolia.functions import align
from spolia.functions.chrono import chrono
from spolia.functions.uri import short_id

OFFSET_BLOCK = 4096
_META_COLUMNS = ("tok_length", "char_length", "date", "author_lat", "book")
# Kinds of set kept while grouping: matched words and characters of either side.
_KINDS = {"WM1": 1, "WM2": 2, "CM1": 3, "CM2": 4}
# Packed word no position can fall in; carries the empty-list mark.
_EMPTY_WORD = -(1 << 60)


def milestone_offsets(records: DataFrame, mode: str = "inclusive", block: int = OFFSET_BLOCK) -> DataFrame:
    """Running number of characters per series in milestone order.

    `inclusive` counts the milestone itself, `exclusive` only those before it.  A series
    may be very long, so the sum is taken in two levels: inside blocks of `block`
    consecutive numbers, then over the block totals.  Both levels read the same shuffle.
    """
    if mode not in ("inclusive", "exclusive"):
        raise ValueError(f"unknown mode {mode!r}")
    in_block = Window.partitionBy("series", "block").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy("series").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Stated here so that both uses of `local` have the same plan and share one shuffle.
    known = "series is not null and block is not null"
    local = records.select(
        "series",
        "seq",
        F.floor(F.col("seq") / F.lit(block)).alias("block"),
        F.length("text").cast("bigint").alias("ch_len"),
    ).where(known).withColumn("local_total", F.sum("ch_len").over(in_block))
    blocks = (
        local.groupBy("series", "block")
        .agg(F.max("local_total").alias("block_total"))
        .select("series", "block", F.coalesce(F.sum("block_total").over(before), F.lit(0)).alias("earlier"))
    )
    own = F.col("ch_len") if mode == "exclusive" else F.lit(0)
    return local.join(blocks, ["series", "block"]).select(
        "series", "seq", "ch_len", (F.col("earlier") + F.col("local_total") - own).alias("ch_offset")
    )


def meta_side(metadata: DataFrame, side: int) -> DataFrame:
    """Metadata columns named for one side of a pair."""
    names = {
        "id": f"T{side}", "tok_length": f"tok_length_B{side}", "char_length": f"ch_length_B{side}",
        "date": f"date_B{side}", "author_lat": f"author_B{side}", "book": f"book{side}",
    }
    return metadata.select(*[F.col(c).alias(n) for c, n in names.items()])


def unique_metadata(metadata: DataFrame) -> DataFrame:
    """Metadata with one row per id; running it fails if an id occurs twice.

    A duplicate would silently multiply the statistics of its book.
    """
    once = metadata.where(F.col("id").isNotNull()).groupBy("id").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in _META_COLUMNS]
    )
    checked = F.when(F.col("_n") == 1, F.col("id")).otherwise(
        F.raise_error(F.concat(F.lit("duplicate metadata id "), F.col("id")))
    )
    return once.select(checked.alias("id"), *_META_COLUMNS)


def join_metadata(pairs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join of a table keyed by `_T1`, `_T2` with the metadata of both books."""
    meta = unique_metadata(metadata)
    for side in (1, 2):
        pairs = pairs.join(meta_side(meta, side), F.col(f"_T{side}") == F.col(f"T{side}"), "left").drop(f"T{side}")
    return pairs


def compared(alignments: DataFrame, kernel: str = "arrow", kept: tuple[str, ...] = ()) -> DataFrame:
    """Alignments reduced to keys, numbers and the marks of the comparison (and the columns `kept`).

    Sides of different length have no marks and are left out, see `split_unequal`.  Marks are counted from the
    passage's own start, so they need no offset: what goes into the later shuffles is a bit per character.
    """
    return alignments.where(F.length("s1") == F.length("s2")).select(
        short_id(F.col("series1")).alias("_T1"),
        short_id(F.col("series2")).alias("_T2"),
        F.col("seq1").cast("bigint").alias("seq1"),
        F.col("seq2").cast("bigint").alias("seq2"),
        "b1", "b2", "bw1", "bw2", "matches",
        align.marks(F.col("s1"), F.col("s2"), kernel).alias("marks"),
        *kept,
    )


def compared_once(alignments: DataFrame, kernel: str = "arrow") -> DataFrame:
    """`compared` of the rows of `clean_alignments`, without moving their texts.

    Rows that repeat are told by 128 bits of hash over all their columns; what the shuffle holds is that and
    the narrow rows.
    """
    rows = alignments.drop("_corrupt_record").na.drop()
    columns = rows.columns
    keyed = rows.withColumns({"_h1": F.xxhash64(*columns), "_h2": F.xxhash64(*reversed(columns), F.lit(1))})
    return compared(keyed, kernel, ("_h1", "_h2")).distinct().drop("_h1", "_h2")


def join_offsets(alignments: DataFrame, records: DataFrame, mode: str = "inclusive") -> DataFrame:
    """Attach `ch_offset1`, `ch_offset2` to rows with `_T1, seq1, _T2, seq2`.

    Inner joins: an alignment whose milestones have no record is lost (`lost_alignments`).
    The offsets are computed once; the second join reuses the first one's shuffle.
    """
    offsets = milestone_offsets(records, mode).select(
        short_id(F.col("series")).alias("sid"), "seq", "ch_offset"
    )
    columns = alignments.columns
    for side in (1, 2):
        o = offsets.alias(f"o{side}")
        alignments = alignments.join(
            o,
            (F.col(f"_T{side}") == F.col(f"o{side}.sid")) & (F.col(f"seq{side}") == F.col(f"o{side}.seq")),
        ).select(*columns, F.col(f"o{side}.ch_offset").alias(f"ch_offset{side}"))
        columns = alignments.columns
    return alignments


def lost_alignments(alignments: DataFrame, records: DataFrame) -> DataFrame:
    """Alignments (with `_T1, seq1, _T2, seq2`) for which a milestone record is missing."""
    known = records.select(short_id(F.col("series")).alias("sid"), F.col("seq").cast("bigint").alias("seq")).distinct()
    for side in (1, 2):
        k = known.select(F.col("sid").alias(f"_T{side}"), F.col("seq").alias(f"seq{side}"), F.lit(True).alias(f"_k{side}"))
        alignments = alignments.join(k, [f"_T{side}", f"seq{side}"], "left")
    missing = F.col("_k1").isNull() | F.col("_k2").isNull()
    return alignments.where(missing).drop("_k1", "_k2")


def duplicate_milestones(records: DataFrame) -> DataFrame:
    """Milestones that two series share once language and extension are dropped.

    They would multiply the alignments joined to them.
    """
    return (
        records.groupBy(short_id(F.col("series")).alias("sid"), "seq")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def _placed(kind: str, words: str, count: str, first: Column, compat: bool) -> Column:
    """Matched positions of one kind; with `compat` an empty set leaves a mark instead."""
    found = F.transform(
        align.placed_words(F.col(f"marks.{words}"), first),
        lambda w: F.struct(F.lit(_KINDS[kind]).alias("kind"), w["word"].alias("word"), w["bits"].alias("bits")),
    )
    if not compat:
        return found
    mark = F.struct(
        F.lit(_KINDS[kind]).alias("kind"), F.lit(_EMPTY_WORD).alias("word"), F.lit(1).cast("bigint").alias("bits")
    )
    return F.concat(found, F.when(F.col(f"marks.{count}") > 0, F.array()).otherwise(F.array(mark)))


def _position_sets(with_chars: bool, ms_len: int, compat: bool) -> list[Column]:
    sets = [
        _placed(f"WM{s}", f"words{s}", f"w{s}", align.first_word(F.col(f"seq{s}"), F.col(f"bw{s}"), ms_len), compat)
        for s in (1, 2)
    ]
    if with_chars:
        sets += [
            _placed(f"CM{s}", "chars", "ch_all", F.col(f"ch_offset{s}") + F.col(f"b{s}"), compat) for s in (1, 2)
        ]
    return sets


def matched_totals(joined: DataFrame, ms_len: int = config.MS_LEN, compat: bool = True) -> DataFrame:
    """Per pair: number of alignments, summary of `matches`, distinct matched positions.

    `joined` is the output of `compared`, with the offsets of `join_offsets` for the
    character totals.  With `compat` a pair that has an alignment without any match counts
    one position more, once per kind and side.

    Two groupings, both combined before their shuffle: by pair and packed word, then by
    pair.  A frequent pair spreads over all its words.
    """
    nothing = F.lit(0).cast("bigint")
    summary = F.array(F.struct(F.lit(0).alias("kind"), nothing.alias("word"), nothing.alias("bits")))
    with_chars = "ch_offset1" in joined.columns
    slots = F.concat(summary, *_position_sets(with_chars, ms_len, compat))
    matches = F.when(F.col("slot.kind") == 0, F.col("matches"))
    by_word = (
        joined.select("_T1", "_T2", "matches", F.explode(slots).alias("slot"))
        .groupBy("_T1", "_T2", F.col("slot.kind").alias("kind"), F.col("slot.word").alias("word"))
        .agg(
            F.bit_or("slot.bits").alias("bits"),
            F.count(matches).alias("n"),
            F.min(matches).alias("lo"),
            F.max(matches).alias("hi"),
            F.sum(matches).alias("total"),
        )
    )

    def distinct_positions(kind: str) -> Column:
        counted = F.when(F.col("kind") == _KINDS[kind], F.bit_count("bits"))
        return F.coalesce(F.sum(counted), F.lit(0)).cast("int").alias(f"{kind}_Total")

    kinds = ["WM2", "WM1"] + (["CM2", "CM1"] if with_chars else [])
    return by_word.groupBy("_T1", "_T2").agg(
        F.sum("n").alias("instances"),
        *[distinct_positions(k) for k in kinds],
        F.min("lo").alias("ch_MATCHES_Min"),
        F.max("hi").alias("ch_MATCHES_Max"),
        (F.sum("total") / F.sum("n")).alias("ch_MATCHES_Mean"),
    )


def with_ratios(stats: DataFrame) -> DataFrame:
    """Matched share of either book, as a fraction; null for a missing or zero length."""
    def share(total: str, length: str) -> Column:
        return F.try_divide(F.col(total).cast("double"), F.col(length).try_cast("double"))

    return stats.withColumns(
        {
            "WM_B2inB1": share("WM2_Total", "tok_length_B2"),
            "WM_B1inB2": share("WM1_Total", "tok_length_B1"),
            "CM_B2inB1": share("CM2_Total", "ch_length_B2"),
            "CM_B1inB2": share("CM1_Total", "ch_length_B1"),
        }
    )


def with_chrono(stats: DataFrame) -> DataFrame:
    """Direction labels for both orders of the pair."""
    one, two = (
        [F.col(f"date_B{s}"), F.col(f"author_B{s}"), F.col(f"book{s}")] for s in (1, 2)
    )
    return stats.withColumns({"chrono_B1B2": chrono(*one, *two), "chrono_B2B1": chrono(*two, *one)})


def book_pair_stats(
    alignments: DataFrame,
    records: DataFrame,
    metadata: DataFrame,
    ms_len: int = config.MS_LEN,
    offset_mode: str = "inclusive",
    compat: bool = True,
    kernel: str = "arrow",
) -> DataFrame:
    """The full book-pair table, one row per pair of short version IDs."""
    joined = join_offsets(compared_once(alignments, kernel), records, offset_mode)
    stats = join_metadata(matched_totals(joined, ms_len, compat), metadata)
    return with_chrono(with_ratios(stats)).select(*schemas.BOOK_STATS_COLUMNS)


def positions_len_stats(joined: DataFrame, compat: bool = True) -> DataFrame:
    """Per pair: smallest, largest and mean number of matched positions of an alignment.

    `joined` is the output of `compared`.  With `compat` an alignment without a match
    counts as one position.
    """
    def size(count: str) -> Column:
        n = F.col(f"marks.{count}")
        return F.greatest(n, F.lit(1)) if compat else n

    sizes = {"words1": size("w1"), "words2": size("w2"), "chars": size("ch_all")}
    summaries = {"min": F.min, "max": F.max, "mean": F.avg}
    return joined.withColumns(sizes).groupBy("_T1", "_T2").agg(
        *[f(c).alias(f"{c}_{name}") for c in sizes for name, f in summaries.items()]
    )
