"""Ranking of a linked list that no machine holds whole: sums of weights from each element to the end of its list.

Each round takes out elements that stand next to none that is taken out too: those whose hash of the round is
below both neighbours', about a third.  An element's neighbours are known by name, so that choice needs no join;
one grouping hands its links to the neighbours and its weights to the one before.  When few enough are left they
are summed in one place (a fixed number, whatever the input), and the rounds are undone in reverse: an element's
sum is its own weights, as they were when it left, and the sum of the one that came after it then.  All rounds
together move about six times the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import written

LAST = 50_000


def suffix_sums(elements: DataFrame, weights: list[str], last: int = LAST) -> DataFrame:
    """`id` and, for each weight, the sum over the element itself and all that follow it.

    `elements` has `id`, `prev`, `next` (bigint; null at the ends) and the weights (bigint, not null).  There may be
    several lists; each id stands once.  `last` bounds the elements that are summed by the driver; an empty table
    gives an empty one.  Lists of one or two elements and the ends of lists stay to the last step, so there must be
    fewer such lists than `last`.
    """
    round_, gone = 0, []
    columns = ["id", "prev", "next", *weights]
    live = written(elements.select(*columns), "ranked")
    count = live.count()
    while count > last:
        removed = written(live.where(_leaves(round_)).select(*columns), "removed")
        live = written(_spliced(live.where(~_leaves(round_)), removed, weights), "ranked")
        gone.append(removed)
        before, count = count, live.count()
        round_ += 1
        if round_ > 40 and count == before:
            raise ValueError(f"{count} elements are ends of lists; at most {last} can be ranked together")
    done = [_summed(live, weights)]
    for removed in reversed(gone):
        known = done[0]
        for more in done[1:]:
            known = known.union(more)
        known = known.select(F.col("id").alias("next"), *[F.col(w).alias(f"{w}_after") for w in weights])
        sums = [(F.col(w) + F.col(f"{w}_after")).alias(w) for w in weights]
        done.append(written(removed.join(known, "next").select("id", *sums), "sums"))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _leaves(round_: int) -> Column:
    rank = {c: F.xxhash64(F.col(c), F.lit(round_)) for c in ("id", "prev", "next")}
    return F.coalesce((rank["id"] < rank["prev"]) & (rank["id"] < rank["next"]) & F.col("prev").isNotNull() & F.col("next").isNotNull(), F.lit(False))


def _spliced(stay: DataFrame, removed: DataFrame, weights: list[str]) -> DataFrame:
    """The list without the removed: their neighbours linked, their weights with the one before."""
    none = F.lit(None).cast("bigint")
    rows = stay.select("id", "prev", "next", *weights, none.alias("new_prev"), none.alias("new_next"))
    to_prev = removed.select(F.col("prev").alias("id"), none.alias("prev"), none.alias("next"), *weights, none.alias("new_prev"), F.col("next").alias("new_next"))
    zero = [F.lit(0).cast("bigint").alias(w) for w in weights]
    to_next = removed.select(F.col("next").alias("id"), none.alias("prev"), none.alias("next"), *zero, F.col("prev").alias("new_prev"), none.alias("new_next"))
    merged = rows.union(to_prev).union(to_next).groupBy("id").agg(
        *[F.max(c).alias(c) for c in ("prev", "next", "new_prev", "new_next")], *[F.sum(w).alias(w) for w in weights]
    )
    return merged.select("id", F.coalesce("new_prev", "prev").alias("prev"), F.coalesce("new_next", "next").alias("next"), *weights)


def _summed(live: DataFrame, weights: list[str]) -> DataFrame:
    """The sums of the few elements that are left, walked from the ends of their lists."""
    rows = {r["id"]: r for r in live.collect()}
    out = []
    for end in (r for r in rows.values() if r["next"] is None):
        sums, at = [0] * len(weights), end
        while at is not None:
            sums = [s + at[w] for s, w in zip(sums, weights, strict=True)]
            out.append((at["id"], *sums))
            at = rows[at["prev"]] if at["prev"] is not None else None
    return live.sparkSession.createDataFrame(out, ", ".join(f"{c} bigint" for c in ("id", *weights)))
