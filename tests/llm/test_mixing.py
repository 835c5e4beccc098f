import math
import random

from pyspark.sql import functions as F

from spolia.llm import mixing as M


def shares(sizes: dict) -> dict:
    """Shared out step by step, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[k % 3] for k, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in names if s not in free)
        total = sum(weight[s] for s in free)
        target = {s: left * weight[s] / total if s in free else 3.0 * sizes[s] for s in names}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        free -= above


def test_targets(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = {f"s{k}": rng.choice([0, 1, 5, 40, 900, 10_000]) for k in range(9)} | {None: 77, "é": 3}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in M.targets(rows).collect()}
        want = shares(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_taken(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(["w"] * int(rng.expovariate(1 / 60))), rng.choice(["a", "a", "a", "b", "c", None])) for k in range(6000)]
    rows += [(None, None, "a"), (9, "", None), (9, "x  y", "b"), (9, "x  y", "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("copies", F.lit("clash"))
    got = M.taken(df).collect()
    assert len(got) == len(rows)
    assert sorted(r.size for r in got) == sorted(len((t or "").split()) for _, t, _ in rows)
    of = {}
    for r in got:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        of.setdefault((r.source_size, r.target), []).append(r.taken)
    assert len(of) == 4
    for (size, target), each in of.items():
        assert target <= 3 * size and abs(sum(each) - target) < 0.02 * target + 20
    assert sorted(map(str, M.taken(df.repartition(3)).collect())) == sorted(map(str, got))  # reruns agree
    assert M.taken(df.limit(0)).count() == 0


def test_mix_repeats_rows(spark):
    rows = [(k, "a b c", "en", "small" if k < 3 else "large", 5) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = M.mix(df.withColumn("copy", F.lit(1)))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert out.where("source = 'small'").count() == 9  # three copies each, at the bound


def plain_copies(rows: list, source_size: int, target: float, offset: float) -> list:
    """Systematic sampling as the definition says it: add up expected copies, emit at each whole number crossed."""
    each, place, out = target / source_size if source_size else 0.0, 0.0, []
    for size in rows:
        out.append(min(math.floor(offset + place + each) - math.floor(offset + place), 3) if size else 0)
        place += each
    return out


def test_draws_equal_a_plain_sampler(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(["w"] * rng.randint(0, 90)), rng.choice("aaab"), k % 2) for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    got = M.mixed(df, keep=("doc_id", "source")).withColumns({
        "class": F.least(F.lit(M.SIZE_CLASSES - 1), F.floor(8 * F.log2(F.col("size") + 1.0))), "salt": F.pmod(F.xxhash64("doc_id"), F.lit(M.SALTS)),
        "offset": F.pmod(F.xxhash64("source", F.lit(False), F.lit(M.SEED)), F.lit(1 << 52)) / float(1 << 52),
    }).collect()
    for source in "ab":
        line = sorted((r for r in got if r.source == source), key=lambda r: (r["class"], r.salt, r.size, r.doc_id))
        want = plain_copies([r.size for r in line], line[0].source_size, line[0].target, line[0].offset)
        assert sum(w != r.copies for w, r in zip(want, line, strict=True)) <= 2  # sums of fractions round differently
        assert abs(sum(w - r.copies for w, r in zip(want, line, strict=True))) <= 1


def test_mix_takes_what_taken_says(spark):
    rng = random.Random(7)
    rows = [(rng.choice([k, 5, None]), rng.choice(["a b", "a b", "c " * rng.randint(0, 30), None]), rng.choice(["en", None]), rng.choice("abcd"), 1) for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    size = {}
    for r in M.mix(df).collect():
        size[r.source] = size.get(r.source, 0) + len(r.text.split())
    taken = M.mixed(df, keep=("source",)).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()
    assert size == {r.source: r.n for r in taken}
    assert {tuple(r) for r in M.mix(df).collect()} <= set(rows)
    assert sorted(map(str, M.mix(df.repartition(7)).collect())) == sorted(map(str, M.mix(df).collect()))
    assert M.mix(df.limit(0)).count() == 0
