import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spolia.llm import fingerprints as P
from spolia.llm.shingles import joined, shingle_hashes, word_hashes


def text(rng, n):
    return " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) + str(rng.randint(0, 999)) for _ in range(n))


def shingles(t, n=5):
    w = t.encode().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_shingle_hashes():
    texts = [b"", b"a b c", b"  a b\tc ", b"\n", b"A b c d e f g", b"a b c d e f g", b"x"]
    hashes, bounds = shingle_hashes(*joined(texts), 5)
    of = [hashes[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert [len(x) for x in of] == [0, 1, 1, 0, 3, 3, 1]
    assert of[1] == of[2] and of[4] != of[5] and of[4][1:] == of[5][1:]
    lower, _ = word_hashes(*joined([b"AbZ abz"]), lower=True)
    assert lower[0] == lower[1]


@pytest.mark.parametrize("size", [3, 40, 900])
def test_likeness(size):
    rng = random.Random(size)
    errors = []
    for _ in range(30):
        a = text(rng, size)
        words = a.split(" ")
        cut = rng.randint(0, size)
        b = " ".join(words[:cut] + text(rng, size - cut).split(" "))
        x, y = P.fingerprints([a.encode(), b.encode()])
        true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        errors.append(abs(P.likeness(x, y) - true))
        assert P.fingerprints([a.encode()])[0] == x
    assert max(errors) < (0.12 if size > 10 else 0.15) and sum(errors) / 30 < 0.05


def test_rows(spark):
    rng = random.Random(1)
    rows = [(k * 3, text(rng, rng.randint(0, 60)) + " é🙂" * (k % 3)) for k in range(300)] + [(None, "null key here"), (901, None), (902, "same"), (903, "same")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("copy", F.lit("clash")).repartition(7)
    got = {r.doc_id: r for r in P.compared(df).collect()}
    assert len(got) == len(rows)
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for (k, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        a, b, c = P.fingerprints([t.encode(), new.encode(), following.encode()])
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (a.hex(), b.hex())
        assert (r.near_edited, r.near_next) == (P.likeness(a, b), P.likeness(a, c))


def test_small_tables(spark):
    one = spark.createDataFrame([(4, "a b c d e f")], "doc_id bigint, text string")
    (row,) = P.compared(one).collect()
    assert row.near_next == 1.0
    assert P.compared(one.limit(0)).count() == 0
    twice = spark.createDataFrame([(4, "x y"), (4, "x y"), (4, None)], "doc_id bigint, text string")
    assert P.compared(twice).count() == 3
