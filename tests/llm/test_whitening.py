import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spolia.llm import whitening as W

KIND = "vec_id bigint, embedding array<float>, label int"


def plain(rows, counted=False):
    """Everything with whole matrices and whole numbers."""
    fit_rows = {}
    for key, v in rows:
        if v is not None and all(e is not None and math.isfinite(e) for e in v):
            fit_rows.setdefault(tuple(math.floor(256 * float(np.float32(e))) for e in v), []).append(key)
    weights = [len(k) if counted else 1 for k in fit_rows.values()]
    n, width = sum(weights), len(next(iter(fit_rows)))
    sums = [sum(w * x[i] for w, x in zip(weights, fit_rows, strict=True)) for i in range(width)]
    matrix = np.repeat(np.array(list(fit_rows), float), weights, axis=0)
    centred = matrix - matrix.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for x, keys in fit_rows.items():
        deviation = sum((n * e - s) ** 2 for e, s in zip(x, sums, strict=True))
        for key in keys:
            for c in range(min(4, width)):
                score = (np.array(x) - np.array(sums) / n) @ vectors[:, -1 - c] / math.sqrt(values[-1 - c])
                out.setdefault((key, c + 1), []).append((n, deviation, score, values[-1 - c] / values.sum()))
    return out


def made(width=10):
    rng = np.random.default_rng(4)
    basis = rng.normal(size=(width, width)) * np.linspace(2, 0.2, width)[:, None]
    rows = [(k, (rng.normal(size=width) @ basis).astype(np.float32).tolist()) for k in range(200)]
    rows += [(1000 + k, rows[7][1]) for k in range(150)]  # a group of copies
    rows += [(3, rows[9][1]), (None, rows[11][1])]
    rows += [(2000, [e + 1e-9 for e in rows[5][1]])]
    return rows + [(3000, None), (3001, [None] + [1.0] * (width - 1)), (3002, [math.nan] * width), (3003, [math.inf] + [0.0] * (width - 1)), (3004, [])]


@pytest.mark.parametrize("counted", [False, True])
def test_against_whole_matrices(spark, counted):
    df = spark.createDataFrame([(*r, 1) for r in made()], KIND).withColumn("x", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("key", F.lit(2)).repartition(4)
    got = {}
    for r in W.whiten(df, counted=counted).collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
    want = plain([r for r in made() if r[1] != []], counted)
    assert got.keys() == want.keys() and all(len(got[k]) == len(want[k]) for k in want)
    signs = {}
    for at, rows in want.items():
        for r, (n, deviation, score, explained) in zip(sorted(got[at], key=lambda r: r.deviation), sorted(rows, key=lambda r: r[1]), strict=True):
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(explained, rel=1e-9) and r.identity_error < 1e-9
            if abs(score) > 0.1:
                signs.setdefault(at[1], set()).add(round(r.whitened / score, 6))
    assert all(s in ({1.0}, {-1.0}) for s in signs.values()) and len(signs) == 4


def test_small_tables(spark):
    df = spark.createDataFrame([], KIND)
    assert W.whiten(df).collect() == []
    one = spark.createDataFrame([(1, [1.0, -0.0], 0), (2, [1.0, 0.0], 0)], KIND)
    assert sorted(tuple(r)[:5] for r in W.whiten(one).collect()) == [(1, 1, 1, 0, None), (1, 2, 1, 0, None), (2, 1, 1, 0, None), (2, 2, 1, 0, None)]


def test_widths_are_fitted_apart_and_flat_directions_are_null(spark):
    rows = [(k, [float(k), 1.0], 0) for k in range(4)] + [(10 + k, [float(k * k)], 0) for k in range(3)]
    got = {(r.vec_id, r.component): r for r in W.whiten(spark.createDataFrame(rows, KIND)).collect()}
    assert len(got) == 4 * 2 + 3
    assert {got[k, 1].n for k in range(4)} == {4} and {got[10 + k, 1].n for k in range(3)} == {3}
    assert got[0, 2].whitened is None and got[0, 1].explained == pytest.approx(1)
    assert sum(got[k, 1].whitened ** 2 for k in range(4)) == pytest.approx(4) and got[0, 1].identity_error < 1e-12


def test_numbers_beyond_64_bits(spark):
    big = [(1, [3e16, 0.0], 0), (2, [-3e16, 1.0], 0), (3, [1e16, 2.0], 0)]
    got = {r.vec_id: r.deviation for r in W.whiten(spark.createDataFrame(big, KIND)).collect()}
    assert got == {1: None, 2: None, 3: None}
    some = [(1, [2e6, 0.0], 0), (2, [-2e6, 1.0], 0), (3, [0.0, 2.0], 0)]
    got = {r.vec_id: r.deviation for r in W.whiten(spark.createDataFrame(some, KIND)).collect()}
    want = plain([r[:2] for r in some])
    assert got == {k: want[k, 1][0][1] for k in (1, 2, 3)}


def test_too_many_widths_are_refused(spark, monkeypatch):
    monkeypatch.setattr(W, "MOST_ENTRIES", 10)
    with pytest.raises(ValueError, match="squared widths"):
        W.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0, 3.0], 0)], KIND)).collect()
