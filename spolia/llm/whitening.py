"""Embedding whitening with a covariance weighted by multiplicity.

Equal integer vectors are grouped first, and everything else is done once for each distinct one: exact sums, a
centred and weighted matrix product for each batch (numpy inside tasks, added up by Spark), the projection on the
leading eigenvectors.  The rows get their results back through a digest of their vector, so a vector that a third
of all rows share costs one whitening and a join that adaptive execution can split.

Only a matrix of width x width numbers ever meets in one place.  Vectors of each width are a list of their own;
the sum of the squared widths must not pass `MOST_ENTRIES`, else the work is refused.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import batch_rows, written

MOST_ENTRIES = 1 << 24
BATCH = 2000
_LONG = 2**63 - 1


@dataclass
class Axes:
    """What the fit list of one width gives: total weight, sums, and the leading components."""

    n: int
    sums: list[int]
    mean: np.ndarray
    vectors: np.ndarray | None = None  # width x components
    values: np.ndarray | None = None
    trace: float = 0.0


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """`key`, `x` (floor(scale * c) as long) and `digest` of the rows whose vector is given and finite throughout."""
    c = F.col(vector)
    fit = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    x = F.transform(c, lambda e: F.floor(e.cast("double") * scale))
    rows = vectors.where(c.isNotNull() & fit).select(F.col(key).alias("key"), x.alias("x"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.array_join(F.transform("x", lambda e: e.cast("string")), ","), 256)))


def distinct(rows: DataFrame) -> DataFrame:
    """Each integer vector once, with the number of rows that have it."""
    return written(rows.groupBy("digest", "x").agg(F.count("*").alias("copies")), "distinct")


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Width, row numbers and matrix of the batch's vectors."""
    column = batch.column(batch.schema.get_field_index("x"))
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    widths = np.diff(offsets)
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        yield width, at, flat[offsets[at][:, None] + np.arange(width)]


def _weights(batch: pa.RecordBatch, at: np.ndarray, counted: bool) -> np.ndarray:
    copies = batch.column(batch.schema.get_field_index("copies")).to_numpy()[at]
    return copies if counted else np.ones_like(copies)


def exact_sums(lists: DataFrame, counted: bool) -> dict[int, Axes]:
    """Weight and sums of each width, without rounding."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for width, at, x in _by_width(batch):
                weights = _weights(batch, at, counted)
                high, low = x >> 32, x & 0xFFFFFFFF
                if weights.max() < 1 << 20:  # then the halves' sums over a batch stay within 64 bits
                    sums = [int(h) * (1 << 32) + int(w) for h, w in zip(weights @ high, weights @ low, strict=True)]
                else:
                    sums = [sum(int(a) * int(b) for a, b in zip(weights, column, strict=True)) for column in x.T]
                was = totals.setdefault(width, [0] * (width + 1))
                totals[width] = [a + b for a, b in zip(was, [int(weights.sum()), *sums], strict=True)]
        rows = [(width, i, str(v)) for width, values in totals.items() for i, v in enumerate(values)]
        yield _table(rows, [("width", pa.int32()), ("i", pa.int32()), ("v", pa.string())])

    parts = lists.mapInArrow(work, "width int, i int, v string")
    found: dict[int, dict[int, int]] = defaultdict(dict)
    widths = [r[0] for r in lists.select(F.size("x").alias("w")).distinct().limit(round((3 * MOST_ENTRIES) ** (1 / 3)) + 2).collect()]  # so many widths are too many anyway
    if sum(w * w for w in widths) > MOST_ENTRIES:
        raise ValueError(f"the squared widths of the vectors add up to more than {MOST_ENTRIES}")
    for r in parts.groupBy("width", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        found[r["width"]][r["i"]] = int(r["v"])
    out = {}
    for width, values in found.items():
        n, sums = values[0], [values[i + 1] for i in range(width)]
        out[width] = Axes(n, sums, np.array([s / n for s in sums]))
    return out


def fit(lists: DataFrame, counted: bool, components: int) -> dict[int, Axes]:
    """The leading eigenvectors of each width's covariance (weighted, centred first, divided by the weight)."""
    axes = exact_sums(lists, counted)
    means = {width: a.mean for width, a in axes.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, at, x in _by_width(batch):
                centred = x - means[width]
                product = centred.T @ (centred * _weights(batch, at, counted)[:, None])
                products[width] = products[width] + product if width in products else product
        for width, product in products.items():
            i, j = np.triu_indices(width)
            for a in range(0, len(i), 1 << 16):
                piece = slice(a, a + (1 << 16))
                columns = [pa.array(np.full(len(i[piece]), width, np.int32)), pa.array(i[piece].astype(np.int32)), pa.array(j[piece].astype(np.int32)), pa.array(product[i[piece], j[piece]])]
                yield pa.record_batch(columns, ["width", "i", "j", "v"])

    sums = lists.mapInArrow(work, "width int, i int, j int, v double").groupBy("width", "i", "j").agg(F.sum("v").alias("v"))
    table = sums.toArrow()
    width, i, j, v = (table.column(c).to_numpy() for c in ("width", "i", "j", "v"))
    for w, a in axes.items():
        here = width == w
        matrix = np.zeros((w, w))
        matrix[i[here], j[here]] = v[here] / a.n
        matrix = np.triu(matrix) + np.triu(matrix, 1).T
        values, vectors = np.linalg.eigh(matrix)
        most = min(components, w)
        a.values, a.vectors, a.trace = values[::-1][:most], vectors[:, ::-1][:, :most], float(np.trace(matrix))
    return axes


def _deviations(x: np.ndarray, a: Axes) -> list[int | None]:
    """Sums of squares of n * x - S in whole numbers; null where a long can't hold it."""
    most = a.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, a.sums))
    if most * most * x.shape[1] <= _LONG:
        return ((x * a.n - np.array(a.sums)) ** 2).sum(axis=1).tolist()
    exact = [sum((a.n * int(e) - s) ** 2 for e, s in zip(row, a.sums, strict=True)) for row in x]
    return [e if e <= _LONG else None for e in exact]


def _table(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256, counted: bool = False, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and leading component: the whitened coordinate and how the fit explains the vectors.

    `key`, `component` (from 1, falling eigenvalue), `n` (weight of the fit list), `deviation` (exact; null beyond a
    long), `whitened`, `explained`, `identity_error`.  The fit list has every distinct integer vector, weighted by one or
    (`counted`) by its rows.  Rows with a null vector, a null or non-finite entry are left out; an empty vector has no
    component and so no row; repeated rows give rows each; an empty table gives an empty one.  Components
    without variance (eigenvalue below 1e-12 of the trace) have null `whitened` and don't count in `identity_error`.
    Vectors of several widths are fitted apart.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, key, vector, scale)
    with batch_rows(spark, BATCH):
        lists = distinct(rows.select("digest", "x"))
        axes = fit(lists, counted, components)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = [("digest", pa.binary()), ("width", pa.int32()), ("copies", pa.int64()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]
            for batch in batches:
                for width, at, x in _by_width(batch):
                    a = axes[width]
                    lively = a.values > 1e-12 * a.trace
                    scores = (x - a.mean) @ a.vectors / np.sqrt(np.where(lively, a.values, 1))
                    table = pa.table({
                        "digest": batch.column(0).take(pa.array(at)), "width": np.full(len(at), width, np.int32), "copies": _weights(batch, at, True), "n": np.full(len(at), a.n),
                        "deviation": pa.array(_deviations(x, a), pa.int64()), "whitened": pa.array([[v if ok else None for v, ok in zip(r, lively, strict=True)] for r in scores.tolist()], kinds[-1][1]),
                    }, schema=pa.schema(kinds))
                    yield from table.to_batches()

        done = written(lists.mapInArrow(work, "digest binary, width int, copies bigint, n bigint, deviation bigint, whitened array<double>"), "whitened")
    errors = identity_errors(done, axes, counted, components)
    summary = [(w, c + 1, float(a.values[c] / a.trace) if a.trace else None, errors.get(w)) for w, a in axes.items() for c in range(len(a.values))]
    summary = spark.createDataFrame(summary, "width int, component int, explained double, identity_error double")
    out = rows.select("key", "digest").join(done.drop("copies"), "digest").select("key", "width", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    out = out.withColumn("component", F.col("at") + 1).join(F.broadcast(summary), ["width", "component"])  # components x widths rows
    return out.select(F.col("key").alias(key), "component", "n", "deviation", "whitened", "explained", "identity_error")


def identity_errors(done: DataFrame, axes: dict[int, Axes], counted: bool, components: int) -> dict[int, float]:
    """Per width the largest absolute entry of the whitened fit list's covariance minus the identity."""
    weight = F.col("copies").cast("double") if counted else F.lit(1.0)
    w = [F.coalesce(F.get("whitened", F.lit(c)), F.lit(0.0)) for c in range(components)]
    means = done.groupBy("width").agg(F.sum(weight).alias("weight"), *[(F.sum(weight * x) / F.sum(weight)).alias(f"m{c}") for c, x in enumerate(w)])
    means = F.broadcast(means)  # a row for each width
    centred = [w[c] - F.col(f"m{c}") for c in range(components)]
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    sums = done.join(means, "width").groupBy("width", "weight").agg(*[F.sum(weight * centred[a] * centred[b]).alias(f"c{a}_{b}") for a, b in pairs])
    out = {}
    for r in sums.collect():
        a = axes[r["width"]]
        lively = (a.values > 1e-12 * a.trace).tolist()
        entries = [abs(r[f"c{i}_{j}"] / r["weight"] - (i == j)) for i, j in pairs if max(i, j) < len(lively) and lively[i] and lively[j]]
        out[r["width"]] = max(entries, default=None)
    return out
