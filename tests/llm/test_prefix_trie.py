import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from spolia.llm import list_ranking as R
from spolia.llm import prefix_trie as P

KIND = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """The trie by dictionaries of whole sequences."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        return t[0], t[1], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()

    own = {c: [t[2:] for t in sorted(ts, key=key)] for c, ts in own.items()}
    nodes = {}
    ends = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        new = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
        for d in range(len(new) + 1):
            nodes.setdefault(new[:d], []).append(c)
        ends.setdefault(new, []).append(c)
    leaf = {n for n in nodes if not any(m[:-1] == n and m for m in nodes)}
    out = []
    for n, members in nodes.items():
        below = [m for m in nodes if m[: len(n)] == n]
        out.append((
            min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), sum(len(m) == len(n) + 1 for m in below), sum(m in leaf for m in below),
            sum((len(nodes[m]) - 1) * len(m[-1][1]) for m in below if m), hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(420), 70):
        for turn in range(rng.randrange(0, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé𝒳", "", None, "long text " * 9])))
    rows += [(100, k, "user", f"turn {k % 7}") for k in range(60)]  # a long one
    rows += [(5, None, "system", "first"), (5, 1, "user", "same"), (5, 1, "user", "same"), (None, 0, "user", "lost"), (-205, 0, "user", "a"), (900, 0, "user", "a")]
    rows += [(c, k, "user", f"copy {k}") for c in range(1000, 1300, 3) for k in range(8)]
    return rows


@pytest.mark.parametrize("seed, block, last", [(1, 1024, 50_000), (2, 3, 20)])
def test_against_plain_dictionaries(spark, seed, block, last):
    df = spark.createDataFrame(made(seed), KIND).withColumn("u", F.lit("clash")).withColumn("depth", F.lit(None)).repartition(5)
    got = sorted((tuple(r) for r in P.trie(df, block=block, last=last).collect()), key=str)
    # negative numbers: the remainder keeps the sign in SQL, not in Python
    rows = [(c, *r) for c, *r in made(seed) if c is None or c >= 0]
    if seed == 1:
        df = df.where("conv_id >= 0 or conv_id is null")
        got = sorted((tuple(r) for r in P.trie(df, block=block, last=last).collect()), key=str)
        assert got == plain(rows)
    else:
        assert {r[0] for r in got if r[1] == 0} == {-205}
        same = [r for r in got if r[1] > 4]
        assert same == [r for r in plain(rows) if r[1] > 4]


def test_many_rounds_give_the_same_trie(spark):
    df = spark.createDataFrame([r for r in made(3) if r[0] is None or r[0] >= 0], KIND).repartition(4)
    got = sorted((tuple(r) for r in P.trie(df, block=2, last=30).collect()), key=str)
    assert got == plain([r for r in made(3) if r[0] is None or r[0] >= 0])


def test_small_tables(spark):
    empty = spark.createDataFrame([], KIND)
    assert P.trie(empty).collect() == []
    nothing = hashlib.sha256(b"").hexdigest()
    df = spark.createDataFrame([(7, None, None, None)], KIND)
    rows = sorted(tuple(r) for r in P.trie(df).collect())
    if zlib.crc32(b"7") % 6 == 0:
        assert rows == [(7, 0, None, 1, 1, 1, 0, nothing), (7, 1, 7, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]
    else:  # its own first turn is not taken and there is no conversation 0
        assert rows == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]


@pytest.mark.parametrize("last", [10, 100_000])
def test_sums_of_a_list(spark, last):
    n, rng = 700, random.Random(5)
    ids = rng.sample(range(10_000), n)
    rows = [(i, ids[k - 1] if k else None, ids[k + 1] if k + 1 < n else None, k, 1) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "id bigint, prev bigint, next bigint, a bigint, b bigint").repartition(3)
    want = [(i, sum(range(k, n)), n - k) for k, i in enumerate(ids)]
    assert sorted(map(tuple, R.suffix_sums(df, ["a", "b"], last).collect())) == sorted(want)
