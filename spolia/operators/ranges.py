"""Milestones of texts that are too long for one task.

A text is a sequence of ranges: pieces of bounded size that follow one another and end with white space (all but
the last), so no token and no tag crosses their ends.  Three narrow levels replace the one pass over a whole text: tokens
are counted range by range, the counts become offsets (sums inside blocks of ranges, then over block totals), and each range
is cut on its own, as its offset says where the milestone that is under way ends.  Only the first and the last
piece of a range can be part of a longer milestone, so only those are ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spolia import config
from spolia.functions import text as txt
from spolia.operators.once import computed_once, exploded

RANGE_CHARS = 1 << 20
RANGE_BLOCK = 1024


def text_ranges(texts: DataFrame, chars: int = RANGE_CHARS, body: str = "body") -> DataFrame:
    """Ranges of texts that are rows: `file_name, pos` (from 0), `piece`.

    A range has `chars` characters and what is left of the last token in it.  A null or empty text has none.
    """
    cut = F.regexp_extract_all(F.col(body), F.lit(f"(?s:.{{{chars}}})\\S*+\\s?|(?s:.++)"), 0)
    return exploded(texts.withColumn("_pieces", cut), ["file_name"], "_pieces", "pos", "piece").select(
        "file_name", F.col("pos").cast("bigint").alias("pos"), "piece"
    )


def body_ranges(lines: DataFrame, splitter: str | None = config.SPLITTER) -> DataFrame:
    """The bodies of files in ranges, as `text.split_header` and `text.right_trim` leave them.

    `lines` are `file_name, pos, piece` of whole files (`readers.read_text_ranges`).  A file without the splitter has no
    row.  White space before the body's first line break and behind its last character belongs to no range.
    """
    if splitter is not None:
        at = F.instr("piece", F.lit(splitter))
        first = lines.where(at > 0).groupBy("file_name").agg(F.min("pos").alias("_head"))
        rest = F.substring("piece", at + len(splitter), F.length("piece"))
        lines = lines.join(first, "file_name").where(F.col("pos") >= F.col("_head"))
        lines = lines.select("file_name", "pos", F.when(F.col("pos") == F.col("_head"), rest).otherwise(F.col("piece")).alias("piece"))
    blank = txt.right_trim(F.col("piece")) == ""
    only_breaks = F.ltrim("piece", F.lit("\n")) == ""
    bounds = lines.groupBy("file_name").agg(
        F.min(F.when(~only_breaks, F.col("pos"))).alias("_first"), F.max(F.when(~blank, F.col("pos"))).alias("_last")
    )
    if splitter is None:
        bounds = bounds.withColumn("_first", F.lit(None).cast("bigint"))
    lines = lines.join(bounds, "file_name").where(F.col("pos") <= F.col("_last"))
    lines = lines.where(F.coalesce(F.col("pos") >= F.col("_first"), F.lit(True)))
    piece = F.when(F.col("pos") == F.col("_first"), F.ltrim("piece", F.lit("\n"))).otherwise(F.col("piece"))
    lines = lines.select("file_name", "pos", "_last", piece.alias("piece"))
    return lines.select("file_name", "pos", F.when(F.col("pos") == F.col("_last"), txt.right_trim(F.col("piece"))).otherwise(F.col("piece")).alias("piece"))


def strip_tags(ranges: DataFrame, ms_regex: str | None = config.MS_TAG_SPACED) -> DataFrame:
    """Ranges without earlier milestone tags; blanks before a tag at the start of a range belong to the range before."""
    return ranges.withColumn("piece", F.regexp_replace("piece", ms_regex or config.MS_TAG_FALLBACK, ""))


def number_ranges(
    ranges: DataFrame, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS, block: int = RANGE_BLOCK
) -> DataFrame:
    """Add `earlier`, the relevant pieces of the text in front of the range, and `pieces`, those in it."""
    place = F.floor(F.col("pos") / block).alias("_block")
    counted = ranges.select("file_name", "pos", place, txt.relevant_pieces(F.col("piece"), token_class).cast("bigint").alias("pieces"))
    inside = Window.partitionBy("file_name", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.groupBy("file_name", "_block").agg(F.sum("pieces").alias("_total"))
    blocks = blocks.select("file_name", "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    local = counted.withColumn("_inside", F.coalesce(F.sum("pieces").over(inside), F.lit(0)))
    offsets = local.join(blocks, ["file_name", "_block"]).select("file_name", "pos", "pieces", (F.col("_before") + F.col("_inside")).alias("earlier"))
    return ranges.join(offsets, ["file_name", "pos"])


def cut_range(piece: Column, earlier: Column, ms_len: int, token_class: str) -> Column:
    """A range cut where milestones end; element i belongs to milestone `earlier div ms_len + i`.

    The first cut completes the milestone under way; an empty last element is left out.
    """
    unit = f"(?:{txt._outside(token_class)}*+{txt._relevant_piece(token_class)})"
    missing = (F.lit(ms_len) - earlier % ms_len).cast("string")
    pattern = F.concat(F.lit(f"\\A{unit}{{"), missing, F.lit(f"}}+|(?!\\A){unit}{{{ms_len}}}+|(?s:.++)"))
    return F.regexp_extract_all(piece, pattern, 0)


def cut_ranges(
    ranges: DataFrame, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS, block: int = RANGE_BLOCK
) -> DataFrame:
    """Pieces of milestones: `file_name, pos, i, n` (number of the milestone, from 1), `piece, inner`.

    `inner`: the piece is a whole milestone, as others of its range stand before and after it.
    """
    numbered = number_ranges(ranges, ms_len, token_class, block)
    # Cut once: a filter on the array would otherwise repeat the cut in the join below.
    numbered = computed_once(numbered, {"_cut": cut_range(F.col("piece"), F.col("earlier"), ms_len, token_class)}).withColumn(
        "_count", F.size("_cut")
    )
    rows = exploded(numbered, ["file_name", "pos", "earlier", "_count"], "_cut", "i", "_piece")
    n = F.floor(F.col("earlier") / ms_len) + F.col("i") + 1
    return rows.select("file_name", "pos", "i", n.alias("n"), F.col("_piece").alias("piece"), ((F.col("i") > 0) & (F.col("i") < F.col("_count") - 1)).alias("inner"))


def milestone_texts(pieces: DataFrame) -> DataFrame:
    """`file_name, n, text` from the pieces of `cut_ranges`.

    Pieces are grouped by milestone: a group is one milestone's text.  Whole milestones stay as they are, each a row.  One pass
    over the pieces, as two would number and cut all ranges twice.
    """
    parts = pieces.groupBy("file_name", "n", "inner").agg(F.array_sort(F.collect_list(F.struct("pos", "i", "piece"))).alias("_parts"))
    texts = F.when(F.col("inner"), F.col("_parts.piece")).otherwise(F.array(F.array_join(F.col("_parts.piece"), "")))
    return exploded(parts.withColumn("_texts", texts), ["file_name", "n"], "_texts", "_k", "text").drop("_k")


def range_widths(ranges: DataFrame, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS) -> DataFrame:
    """`file_name, width`: digits of the number of milestones, as `text.label_width` has them for a whole text."""
    total = F.sum(txt.token_count(F.col("piece"), token_class))
    return ranges.groupBy("file_name").agg(F.length(F.floor(total / ms_len).cast("string")).alias("width"))


def milestone_rows(
    ranges: DataFrame, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS, block: int = RANGE_BLOCK
) -> DataFrame:
    """`file_name, n, ms_label, text` of unsplit texts, as `milestones.milestone_rows` gives them for texts in one row."""
    texts = milestone_texts(cut_ranges(ranges, ms_len, token_class, block))
    label = txt.milestone_label(F.lit(None).cast("string"), F.col("n"), F.col("width"))
    return texts.join(range_widths(ranges, ms_len, token_class), "file_name").select("file_name", "n", label.alias("ms_label"), "text")


def tagged_ranges(
    ranges: DataFrame, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS, block: int = RANGE_BLOCK
) -> DataFrame:
    """`file_name, pos, piece`: the ranges with a tag behind each milestone, the last one included.

    In order they are the tagged body; no text is put together.
    """
    numbered = number_ranges(ranges, ms_len, token_class, block).join(range_widths(ranges, ms_len, token_class), "file_name")
    numbered = numbered.join(ranges.groupBy("file_name").agg(F.max("pos").alias("_last")), "file_name")
    cut = cut_range(F.col("piece"), F.col("earlier"), ms_len, token_class)
    numbered = numbered.withColumn("_cut", cut).withColumn("_ends", F.floor((F.col("earlier") + F.col("pieces")) / ms_len) - F.floor(F.col("earlier") / ms_len))
    none = F.lit(None).cast("string")

    def tagged(piece: Column, i: Column) -> Column:
        label = txt.milestone_label(none, F.floor(F.col("earlier") / ms_len) + i.cast("bigint") + 1, F.col("width"))
        final = (F.col("pos") == F.col("_last")) & (i == F.size("_cut") - 1)
        return F.when((i < F.col("_ends")) | final, F.concat(piece, F.lit(" "), label)).otherwise(piece)

    return numbered.select("file_name", "pos", F.array_join(F.transform("_cut", tagged), "").alias("piece"))
