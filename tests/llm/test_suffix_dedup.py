import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spolia.llm import suffix_dedup as D
from spolia.llm.suffix_groups import suffix_order


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_order(symbols):
    for s in ([*symbols, 0], [*symbols * 3, 0]):
        assert suffix_order(s) == sorted(range(len(s)), key=lambda k: s[k:])


def brute(texts):
    w, seen = D.WINDOW, {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - w + 1):
            seen[raw[i : i + w]] = seen.get(raw[i : i + w], 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - w + 1):
            if seen[raw[i : i + w]] > 1:
                gone[i : i + w] = b"\1" * w
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé日", k=rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(60), text(34), text(30)[:201], text(30)[:199], "z" * 700, "ab" * 300, "日本語" * 90]
    texts = ["", None, "short", "z" * 199, "z" * 200, "q" * 201]
    for _ in range(60):
        t = text(rng.randint(0, 50))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 40)
            t += rng.choice(["", " ", "."]) + p[a : len(p) - rng.randint(0, 40)] + text(rng.randint(0, 30))
        texts.append(t)
        if rng.random() < 0.2:
            texts.append(t)
        if rng.random() < 0.2:
            texts.append(t[: len(t) // 2] + "X" + t[len(t) // 2 :])
    texts.append(texts[7] + texts[7])
    return texts


@pytest.mark.parametrize("seed, most", [(1, 2000), (2, 2000), (3, 3)])
def test_against_all_windows(spark, monkeypatch, seed, most):
    monkeypatch.setattr(D, "MOST_CONTEXTS", most)
    texts = corpus(seed)
    df = spark.createDataFrame([(k if k % 9 else None, t) for k, t in enumerate(texts)], "doc_id bigint, text string").withColumn("uid", F.lit("clash"))
    got = [tuple(r)[1:] for r in D.digest(df).collect()]
    want = brute(texts)
    assert sum(w[1] for w in want) > 5000
    assert sorted(got) == sorted(want)


def test_small_tables(spark):
    df = spark.createDataFrame([(1, "a" * 400), (2, None)], "doc_id bigint, text string")
    assert {tuple(r)[:4] for r in D.digest(df).collect()} == {(1, 400, 400, 1), (2, 0, 0, 0)}
    assert D.digest(df.limit(0)).count() == 0


def test_other_splits_between_jobs(spark, monkeypatch, tmp_path):
    texts = corpus(4)
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "texts"))
    inner, name = D._cut_out, "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)

    def later(*of):
        spark.conf.set(name, "0")  # the files are cut into other parts from here on
        return inner(*of)

    monkeypatch.setattr(D, "_cut_out", later)
    try:
        got = [tuple(r)[1:] for r in D.digest(spark.read.parquet(str(tmp_path / "texts"))).collect()]
    finally:
        spark.conf.set(name, before)
    assert sorted(got) == sorted(brute(texts))
