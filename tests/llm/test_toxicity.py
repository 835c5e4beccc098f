import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spolia.llm import toxicity as T


def corpus(n, seed):
    rng = random.Random(seed)
    parts = ["lo", "ra", "mi", "ten", "sho", "ka", "bru"]
    rows = []
    for k in range(n):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 120))]
        toxic = k % 4 == 0
        for _ in range(1 + rng.randint(0, 2)) if toxic else ():
            words.insert(rng.randint(0, len(words)), rng.choice(["vexgrub", "Zorwit", "zorwitka"]))
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_windows_hold_the_last_bytes():
    keys, bounds = T.windows([b"ab", b""])
    raw = [int(k).to_bytes(6, "big") for k in keys]
    assert raw == [b"\x02" * 5 + b"a", b"\x02" * 4 + b"ab", b"\x02\x02\x02ab\x03", b"\x02" * 5 + b"\x03"]
    assert bounds.tolist() == [0, 3, 4]


def test_probabilities_sum_to_one():
    words = [b"abc", b"abd", b"b", b"bbb"]
    model = T.ClassModels.count(words, np.array([[3, 0], [2, 1], [0, 5], [1, 1]]))
    alphabet = [*b"abcd", 3]
    for context in (b"\x02\x02\x02ab", b"\x02" * 5, b"\x02bbbb"):
        p = np.full((256, 2), 1 / 256)
        keys = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], np.uint64)
        for order, ((grams, own), (ctx, back)) in enumerate(model.levels, 1):
            gram = T._suffix(keys, order)
            p = T._look_up(grams, own, gram, 0.0) + T._look_up(ctx, back, gram >> np.uint64(8), 1.0) * p
        assert p.sum(axis=0) == pytest.approx([1, 1])
        assert (p[alphabet] > 0).all()


def test_held_out_accuracy(spark):
    rows = corpus(900, 1)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(None, None), (5000, ""), (0, rows[0][1])], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows] + [(None, 1), (77777, 1), (5, None)], "doc_id bigint, toxic int")
    got = T.judged(docs.withColumn("score", F.lit("clash")), labels).collect()
    assert len(got) == 903
    truth = {k: y for k, _, y in rows}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    same = [r.score for r in got if r.doc_id == 0]
    assert same[0] == same[1]


def test_labels_held_out_teach_nothing(spark):
    rows = corpus(300, 2)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id bigint, text string")
    out = [zlib.crc32(str(k).encode()) % 3 == 1 for k, _, _ in rows]
    a = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id bigint, toxic int")
    b = spark.createDataFrame([(k, 1 - y if o else y) for (k, _, y), o in zip(rows, out)], "doc_id bigint, toxic int")
    assert sorted(T.judged(docs, a).collect()) == sorted(T.judged(docs, b).collect())


def test_empty_and_one_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.predicted for r in T.judged(docs, none).collect()} == {0}
    assert T.judged(docs.limit(0), none).count() == 0
    assert T.judged(docs, spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")).count() == 2


def test_prior_is_that_of_all_labels_when_ordinary_rows_are_capped(spark):
    rng = random.Random(7)
    rows = []
    for k in range(3000):
        toxic = k % 8 == 0
        words = ["".join(rng.choices(["lo", "ra", "mi", "ten", "sho"], k=2)) for _ in range(20)]
        if rng.random() < (0.6 if toxic else 0.15):
            words.insert(rng.randint(0, 20), "zorwit")
        rows.append((k, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id bigint, toxic int")
    mean = [T.scores(docs, T.train(docs, labels, most)).agg(F.avg("score")).first()[0] for most in (4000, 260)]
    assert mean[0] == pytest.approx(1 / 8, abs=0.04)
    assert mean[1] == pytest.approx(mean[0], abs=0.06)
