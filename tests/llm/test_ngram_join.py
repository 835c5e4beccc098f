import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spolia.llm import common
from spolia.llm import components as components_of
from spolia.llm import ngram_join as N
from spolia.llm.common import discard, written
from spolia.llm.components import components


def brute(rows, near=90, n=3):
    sets = []
    for key, text in rows:
        w = [x.decode() for x in (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and None not in (rows[a][0], rows[b][0]):
                both = len(sets[a] & sets[b])
                if 100 * both >= near * (len(sets[a]) + len(sets[b]) - both):
                    links[a] += 1
                    links[b] += 1
                    parent[root(a)] = root(b)
    low = {}
    for k, (key, _) in enumerate(rows):
        low[root(k)] = min(low.get(root(k), key), key) if key is not None and low.get(root(k), key) is not None else key
    return sorted((str(key), len(sets[k]), links[k], str(low[root(k)])) for k, (key, _) in enumerate(rows))


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 4)))
    texts = []
    while len(texts) < n:
        base = [word() for _ in range(rng.choice([1, 2, 3, 5, 11, 12, 30, 80, 400]))]
        for _ in range(rng.choice([1, 1, 2, 12])):
            t = list(base)
            for _ in range(rng.randint(0, 1 + len(t) // 40)):
                kind, at = rng.random(), rng.randint(0, len(t) - 1)
                if kind < 0.4:
                    t[at] = word()
                elif kind < 0.7:
                    t.insert(at, word())
                elif len(t) > 1:
                    del t[at]
            texts.append(rng.choice([" ", "  ", "\n"]).join(t if rng.random() < 0.8 else map(str.upper, t)))
    return list(enumerate(texts[:n]))


@pytest.mark.parametrize("seed, group", [(1, 256), (2, 3)])
def test_all_links(spark, monkeypatch, seed, group):
    monkeypatch.setattr(N, "GROUP", group)
    rows = corpus(seed, 260) + [(900, None), (901, ""), (902, " \n"), (None, "a b c d"), (903, "a b c d"), (904, "A b C d"), (904, "x y z q"), (904, "A b C d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("parts", F.lit("clash")).repartition(4)
    got = N.join(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.n_links, str(r.component_id)) for r in got) == brute(rows)
    got = N.join(df, shingle=5, near=80).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.n_links, str(r.component_id)) for r in got) == brute(rows, 80, 5)


@pytest.mark.parametrize("group", [2, 5])
def test_components_without_counts(spark, monkeypatch, group):
    """Clusters over many groups: not all pairs of groups are opened, but no component falls apart."""
    monkeypatch.setattr(N, "GROUP", group)
    rng = random.Random(group)
    rows = corpus(9, 120)
    base = [f"w{k}" for k in range(60)]
    for k in range(60):  # near copies of one text
        rows.append((1000 + k, " ".join(base + [f"end{k}"])))
    chain = [f"c{k}" for k in range(90)]
    for k in range(40):  # each like the next, the ends unlike
        rows.append((2000 + k, " ".join([f"n{j}" for j in range(k)] + chain[k:])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = N.join(df, shingle=5, near=80, counts=False).collect()
    assert sorted((r.doc_id, str(r.component_id)) for r in got) == sorted((int(k), c) for k, _, _, c in brute(rows, 80, 5))


def test_size_classes():
    least = N.size_classes(90)
    for n in [*range(1, 400), 10_000, 123_457]:
        k = int(np.searchsorted(least, n, side="right")) - 1
        assert n * 10 // 9 < least[k + 2]


def test_small_tables(spark):
    df = spark.createDataFrame([(3, "a b c"), (1, "a b c")], "doc_id bigint, text string")
    assert sorted(map(tuple, N.join(df).collect())) == [(1, 1, 1, 1), (3, 1, 1, 1)]
    assert N.join(df.limit(0)).count() == 0
    assert [r.doc_id for r in N.one_of_each(df, ("doc_id", "text"), 5, 80).collect()] == [1]


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 7), (50, 50), (60, 61), (61, 60), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 1, 60: 60, 61: 60}


def test_one_of_each_with_repeated_keys(spark):
    """Rows that share a key are judged by their texts: copies of a row go, others with its key do not."""
    def words(name, n=40):
        return " ".join(f"{name}{k}" for k in range(n))

    rows = [
        (1, words("a"), "x"), (2, words("a") + " end", "x"),  # near copies of ordinary keys
        (2, words("b"), "x"),  # shares the key of a dropped copy
        (3, words("c"), "y"), (3, words("c"), "x"), (3, words("c"), None),  # repeated rows
        (4, words("d"), "x"), (4, words("d") + " end", "x"),  # near copies that share a key
        (5, words("e"), "x"), (5, words("f"), "x"),  # share a key only
        (6, words("g"), "x"), (7, words("g"), "x"), (7, words("h"), "x"),  # the key that one row has stays
        (8, "", "x"), (8, "", "x"), (8, None, "x"), (8, " \n", "x"),  # no words: no copies
        (None, words("a"), "x"), (None, words("a"), "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("extra", F.lit(1))
    got = [tuple(r) for r in N.one_of_each(df, ("doc_id", "text", "lang"), 5, 80).collect()]
    fixed = [(1, words("a"), "x"), (2, words("b"), "x"), (3, words("c"), None), (5, words("e"), "x"), (5, words("f"), "x"),
             (6, words("g"), "x"), (7, words("h"), "x"), (8, "", "x"), (8, "", "x"), (8, None, "x"), (8, " \n", "x"),
             (None, words("a"), "x"), (None, words("a"), "x")]
    of_four = [r for r in got if r[0] == 4]
    assert len(of_four) == 1 and of_four[0] in rows
    assert sorted(map(str, got)) == sorted(map(str, fixed + of_four))
    assert sorted(map(str, got)) == sorted(map(str, map(tuple, N.one_of_each(df.repartition(5), ("doc_id", "text", "lang"), 5, 80).collect())))


def test_one_of_each_with_a_key_of_many_rows(spark):
    """One key holds a third of all rows, most of them different texts."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=30)) for _ in range(200)]
    rows = [(0, t) for t in texts[:100]] + [(0, t) for t in texts[:20]] + [(k + 1, t) for k, t in enumerate(texts[80:])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in N.one_of_each(df, ("doc_id", "text"), 5, 80).collect()]
    want = [(0, t) for t in texts[:80]] + [(k + 1, t) for k, t in enumerate(texts[80:])]
    assert sorted(got) == sorted(want)


def test_rows_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Pairs of groups grow with the sets of a cluster, not with their square."""
    monkeypatch.setattr(N, "GROUP", 4)
    base = [f"w{k}" for k in range(100)]
    met, written = [], N.written

    def counting(df, name):
        out = written(df, name)
        if name == "met":
            met.append(out.count())
        return out

    monkeypatch.setattr(N, "written", counting)
    for n in (36, 144):
        rows = [(k, " ".join([*base, f"end{k}"])) for k in range(n)]
        got = N.join(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
        assert sorted((str(r.doc_id), r.n_shingles, r.n_links, str(r.component_id)) for r in got) == brute(rows)
    assert 0 < met[1] <= 7 * met[0]


def similar(a, b, near):
    both = len(np.intersect1d(a, b))
    return 100 * both >= near * (len(a) + len(b) - both)


@pytest.mark.parametrize("near", [50, 80, 90])
def test_sketches_lose_no_similar_set(near):
    """What sketches rule out is similar to no other set, whatever the sizes; most unlike sets are ruled out."""
    rng = np.random.default_rng(near)
    sets = [np.zeros(0, np.uint64)]
    for size in (1, 2, 7, 31, 33, 60, 64, 70, 500, 1100):
        for _ in range(3):
            base = rng.integers(0, 1 << 63, size).astype(np.uint64)
            for share in (1.0, 0.98, near / 100 + 0.02, 0.75, 0.4):
                sets.append(np.unique(np.concatenate([base[: round(share * size)], rng.integers(0, 1 << 63, rng.integers(0, 2 + size // 9)).astype(np.uint64)])))
    sets = [sets[k] for k in rng.permutation(len(sets))]
    sizes, odd = np.array([len(s) for s in sets]), [N.sketch_of(s)[1:] for s in sets]
    side = rng.integers(0, 2, len(sets))
    for paired in (False, True):
        marked = N.maybe_similar(sizes, odd, side if paired else np.zeros(len(sets), int), paired, near)
        true = np.array([any(j != k and (not paired or side[j] != side[k]) and similar(sets[j], sets[k], near) for j in range(len(sets))) for k in range(len(sets))])
        assert not (true & ~marked).any()
    unlike = [rng.integers(0, 1 << 63, 300).astype(np.uint64) for _ in range(40)]
    unlike = [np.unique(np.concatenate([u, unlike[0][:150]])) for u in unlike[1:]]  # a third in common
    assert not N.maybe_similar(np.array([450] * 39), [N.sketch_of(u)[1:] for u in unlike], np.zeros(39, int), False, near).any()


def test_disk_of_texts_with_a_common_passage(spark, monkeypatch, tmp_path):
    """Texts that share parts without being similar leave neither tokens nor parts on disk; near copies among them are found."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage = [word() for _ in range(800)]
    rows = [(k, " ".join(passage + [word() for _ in range(1200)])) for k in range(150)]
    rows += [(200, rows[7][1] + " end"), (201, rows[9][1] + " end")]
    names = []

    def counting(df, name):
        out = written(df, name)
        names.append((name, out.count()))
        return out

    monkeypatch.setattr(N, "written", counting)
    monkeypatch.setattr(components_of, "written", counting)
    monkeypatch.setattr(common, "shared_folder", lambda _, name: f"{tmp_path}/a b/{name}-{len(names)}")
    got = N.join(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), shingle=5, near=80).collect()
    left = sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file())
    assert {r.doc_id: r.component_id for r in got if r.n_links} == {7: 7, 200: 7, 9: 9, 201: 9}
    assert left < 0.2 * sum(len(t) for _, t in rows)  # 1.5 times with tables of parts and tokens
    assert dict(names)["members"] > 100 and dict(names)["kept"] == 4


def test_rounds_of_groups(spark, monkeypatch):
    """Parts placed in several passes and groups opened in many rounds give the same links as all at once."""
    monkeypatch.setattr(N, "GROUP", 3)
    monkeypatch.setattr(N, "ROUND_SHARE", 0.4)
    monkeypatch.setattr(N, "PASS_SHARE", 0.3)
    base = [f"w{k}" for k in range(60)]
    rows = corpus(5, 40) + [(1000 + k, " ".join([*base, f"end{k}"])) for k in range(14)]
    names = []
    monkeypatch.setattr(N, "written", lambda df, name: names.append(name) or written(df, name))
    got = N.join(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), shingle=5, near=80).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.n_links, str(r.component_id)) for r in got) == brute(rows, 80, 5)
    assert names.count("placed") > 1 and names.count("linked") > 1


def test_written_leaves_no_shuffle_files(spark):
    def files():
        every = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {every.apply(k).getName() for k in range(every.size()) if every.apply(k).getName().startswith("shuffle_")}

    before = files()
    out = written(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not files() - before
    file = out.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(file)
    discard(out)
    assert not os.path.exists(os.path.dirname(file))
