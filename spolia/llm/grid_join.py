"""Epsilon grid order join: links between vectors of a cosine of at least `cosine`.

Unit vectors are projected on the leading principal directions and sorted by their cells of a grid of width
epsilon (the distance that belongs to the cosine).  The sorted sequence is cut into runs of LEAF vectors, each with
its bounding box.  Pairs of intervals are opened recursively, FAN parts at a time, from the pair (everything,
everything) down to pairs of runs, skipping those whose boxes lie further apart than epsilon; each step is an equi-join
on the interval.  A task gets two runs, goes on in the same way to tiles of TILE vectors, and compares what is left in
double precision.  Equal vectors enter once with their number.  All this is done for each length of vectors apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spolia.llm.common import batch_rows, written
from spolia.llm.components import components, roots

DIRECTIONS = 10  # leading principal directions of the grid
SORTED_BY = 4  # of them, those that the cells are sorted by
SAMPLE = 4096  # at most so many vectors fit the directions (they decide what is skipped, never what is found)
LEAF, TILE, FAN = 2048, 128, 8
SLACK = 1e-9  # rounding of projections


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def distinct_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(`h1`, `h2`, `rep`, `n`, `v`) once per valid vector, and (`key`, `h1`, `h2`) of every row, null for invalid ones."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(key).alias("key"), F.when(valid, v).alias("v"))
    sum_of = F.aggregate(F.transform("v", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("v", F.when((sum_of > 0) & (sum_of < float("inf")), F.col("v")))
    marks = [F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(s), "v")).alias(f"h{s}") for s in (1, 2)]
    members = rows.select("key", *marks)
    once = rows.where("v is not null").select("key", "v", *marks).groupBy("h1", "h2")
    return once.agg(F.min("key").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v")), members


def principal(distinct: DataFrame) -> np.ndarray:
    """Leading principal directions (columns) of a bounded sample: the vectors of the smallest hashes."""
    x = unit(distinct.select("h1", "h2", "v").orderBy("h1", "h2").limit(SAMPLE).toArrow()["v"].to_pylist())
    x -= x.mean(axis=0)
    values, directions = np.linalg.eigh(x.T @ x)
    return directions[:, np.argsort(-values)[:DIRECTIONS]]


def runs(distinct: DataFrame, directions: np.ndarray, epsilon: float) -> DataFrame:
    """`rank`, `low`, `high` and the vectors (`reps`, `counts`, `data`) of every run of the grid order."""
    width = len(directions)
    sort_by = [f"c{k}" for k in range(min(SORTED_BY, directions.shape[1]))]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            if rows:
                at = np.floor(unit([r["v"] for r in rows]) @ directions[:, : len(sort_by)] / epsilon).astype(np.int32)
                yield pa.record_batch([pa.array([r["rep"] for r in rows], pa.int64()), pa.array([r["n"] for r in rows], pa.int64()),
                                       pa.array([np.array(r["v"], np.float64).tobytes() for r in rows], pa.binary()),
                                       *[pa.array(c, pa.int32()) for c in at.T]], ["rep", "n", "v", *sort_by])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def run(rows: list[dict]) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(r["v"] for r in rows), np.float64).reshape(len(rows), width)
            at = unit(x) @ directions
            row = [part, seq, at.min(axis=0).tolist(), at.max(axis=0).tolist(), [r["rep"] for r in rows], [r["n"] for r in rows], x.tobytes()]
            types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)],
                                   ["part", "seq", "low", "high", "reps", "counts", "data"])

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= LEAF:
                yield run(held[:LEAF])
                seq, held = seq + 1, held[LEAF:]
        if held:
            yield run(held)

    placed = distinct.mapInArrow(cells, "rep bigint, n bigint, v binary" + "".join(f", {c} int" for c in sort_by))
    ordered = placed.repartitionByRange(*sort_by, "rep").sortWithinPartitions(*sort_by, "rep")
    schema = "part int, seq int, low array<double>, high array<double>, reps array<bigint>, counts array<bigint>, data binary"
    found = written(ordered.mapInArrow(cut, schema), "runs")
    parts = found.groupBy("part").agg(F.count("*").alias("n_runs"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n_runs").over(before), F.lit(0)).alias("base"))
    return found.join(parts, "part").withColumn("rank", F.col("base") + F.col("seq")).drop("part", "seq", "base")


def near_pairs(boxes: DataFrame, epsilon: float) -> DataFrame:
    """Pairs `i` <= `j` of runs whose boxes (`rank`, `low`, `high`) are within epsilon, found by recursion from the whole."""
    count = boxes.count()
    levels = [boxes]
    while count > 1:
        lows = [F.min(F.get("low", F.lit(k))).alias(f"l{k}") for k in range(DIRECTIONS)]
        highs = [F.max(F.get("high", F.lit(k))).alias(f"h{k}") for k in range(DIRECTIONS)]
        upper = levels[-1].groupBy(F.floor(F.col("rank") / FAN).alias("rank")).agg(*lows, *highs)
        levels.append(upper.select("rank", F.array(*[f"l{k}" for k in range(DIRECTIONS)]).alias("low"),
                                   F.array(*[f"h{k}" for k in range(DIRECTIONS)]).alias("high")))
        count = -(-count // FAN)
    pairs = levels[-1].select(F.col("rank").alias("i"), F.col("rank").alias("j"))
    for level in reversed(levels[:-1]):
        inner = level.withColumn("up", F.floor(F.col("rank") / FAN))
        sides = [inner.select(*[F.col(c).alias(f"{c}_{s}") for c in inner.columns]) for s in "ij"]
        opened = pairs.join(sides[0], F.col("i") == F.col("up_i")).join(sides[1], F.col("j") == F.col("up_j"))
        gaps = F.zip_with(
            F.zip_with("low_i", "high_j", lambda a, b: a - b), F.zip_with("low_j", "high_i", lambda a, b: a - b),
            lambda a, b: F.greatest(a, b, F.lit(0.0)),
        )
        square = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + F.coalesce(g * g, F.lit(0.0)))
        opened = opened.where((F.col("rank_i") <= F.col("rank_j")) & (square <= (epsilon + SLACK) ** 2))
        pairs = opened.select(F.col("rank_i").alias("i"), F.col("rank_j").alias("j"))
    return pairs


def _open(one: tuple[int, int], two: tuple[int, int], at: np.ndarray, epsilon: float, same: bool) -> Iterator[tuple[slice, slice]]:
    """Tiles of two intervals of a sequence, halved again and again where the boxes are near."""
    if not (one[0] < one[1] and two[0] < two[1]) or same and one[0] > two[0]:
        return
    a, b = at[one[0] : one[1]], at[two[0] : two[1]]
    gap = np.maximum(np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)), 0)
    if gap @ gap > (epsilon + SLACK) ** 2:
        return
    if max(len(a), len(b)) <= TILE:
        yield slice(*one), slice(*two)
        return
    halves = [[(x, min(y, x + h)), (min(y, x + h), y)] for (x, y) in (one, two)
              for h in [max(TILE, 1 << max(0, (y - x - 1).bit_length() - 1))]]
    for p in halves[0]:
        for q in halves[1]:
            yield from _open(p, q, at, epsilon, same)


def compare(x: np.ndarray, counts: np.ndarray, split: int, directions: np.ndarray, cosine: float, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (weighted by counts) of each vector, and its local component; `split` > 0: only links across it."""
    u = unit(x)
    at = u @ directions
    links, parent = np.zeros(len(x), np.int64), np.arange(len(x))
    one, two = ((0, split), (split, len(x))) if split else ((0, len(x)), (0, len(x)))
    for p, q in _open(one, two, at, epsilon, not split):
        near = u[p] @ u[q].T >= cosine
        if p == q:
            np.fill_diagonal(near, False)
        if not near.any():
            continue
        links[p] += near @ counts[q]
        if p != q:
            links[q] += near.T @ counts[p]
        a, b = np.nonzero(near)
        parent = roots(parent, a + p.start, b + q.start)
    return links, parent


def linked_vectors(distinct: DataFrame, cosine: float, epsilon: float) -> DataFrame:
    """`rep`, `n` (links) and `low` (one of its component) of vectors of one length, a row for each pair of runs with links."""
    directions = principal(distinct)
    width = len(directions)
    found = runs(distinct, directions, epsilon)
    pairs = near_pairs(found.select("rank", "low", "high"), epsilon)
    sides = [found.select(*[F.col(c).alias(f"{c}_{s}") for c in ("rank", "reps", "counts", "data")]) for s in "ij"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                same = row["i"] == row["j"]
                reps = np.array(row["reps_i"] + ([] if same else row["reps_j"]), np.int64)
                counts = np.array(row["counts_i"] + ([] if same else row["counts_j"]), np.int64)
                data = np.frombuffer(row["data_i"] + (b"" if same else row["data_j"]), np.float64).reshape(-1, width)
                n, parent = compare(data, counts, 0 if same else len(row["reps_i"]), directions, cosine, epsilon)
                low = np.full(len(reps), np.iinfo(np.int64).max)
                np.minimum.at(low, parent, reps)
                some = n > 0
                yield pa.record_batch([pa.array(reps[some]), pa.array(n[some]), pa.array(low[parent][some])], ["rep", "n", "low"])

    joined = pairs.join(sides[0], F.col("i") == F.col("rank_i")).join(sides[1], F.col("j") == F.col("rank_j"))
    joined = joined.select("i", "j", "reps_i", "counts_i", "data_i", "reps_j", "counts_j", "data_j")
    with batch_rows(distinct.sparkSession, 8):
        return written(joined.mapInArrow(work, "rep bigint, n bigint, low bigint"), "linked")


def links(df: DataFrame, cosine: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`key`, `n_links`, `component_id`, `kept` of every row.

    Rows with equal vectors are linked with each other and share their links.  Null or zero vectors and those with
    null or non-finite components link with nothing; vectors of different lengths have no links with each other.
    Rows with equal keys count as one vector each; a null key is a component of its own.  An empty table gives none.
    """
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    distinct, members = distinct_vectors(df, key, vector)
    distinct = written(distinct, "vectors")
    lengths = distinct.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).where("n > 1").orderBy("length").collect()
    none = df.sparkSession.createDataFrame([], "rep bigint, n bigint, low bigint")
    linked = reduce(DataFrame.union, [linked_vectors(distinct.where(F.size("v") == r["length"]), cosine, epsilon) for r in lengths], none)
    of_rep = distinct.select("h1", "h2", "rep", (F.col("n") - 1).alias("equal"))
    of_rep = of_rep.join(linked.groupBy("rep").agg(F.sum("n").alias("others")), "rep", "left")
    of_rep = of_rep.join(components(linked.select(F.col("rep").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "rep"), "rep", "left")
    of_rep = of_rep.select("h1", "h2", (F.col("equal") + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = members.join(of_rep, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "key")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"))
