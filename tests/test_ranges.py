"""Milestones by ranges against the one-row way, and files read in ranges against their bytes."""

import random

import pytest
from pyspark.sql import functions as F

from spolia.operators import milestones as ms, ranges as rg
from spolia.plans import prepare
from spolia.sources import readers

LETTERS = r"\p{L}"


def made_texts(seed=4):
    rng = random.Random(seed)
    pieces = ["word", "a", "ab12", "12", "...", "é", "نص", " ", "\n", "  ", "\t", "# ", "~~", "_", "x" * 80, "-", "\xa0"]
    texts = ["", None, " ", "one", "\n\n", "a " * 61, "a" * 400, "... " * 90]
    return texts + ["".join(rng.choice(pieces) for _ in range(rng.randrange(900))) for _ in range(40)]


@pytest.mark.parametrize("chars, ms_len, block", [(50, 7, 3), (1, 1, 1024), (200, 30, 2), (10_000, 5, 1024)])
def test_same_milestones_as_whole_texts(spark, chars, ms_len, block):
    rows = [(f"f{k}", text) for k, text in enumerate(made_texts())]
    texts = spark.createDataFrame(rows, "file_name string, body string").repartition(3)
    ranges = rg.text_ranges(texts, chars)
    whole = ms.assign_milestones(texts, ms_len, LETTERS).withColumns({"part": F.lit(None).cast("string"), "start": F.lit(0).cast("bigint")})
    want = {(r.file_name, r.n): (r.ms_label, r.text) for r in ms.milestone_rows(whole).collect()}
    got = {(r.file_name, r.n): (r.ms_label, r.text) for r in rg.milestone_rows(ranges, ms_len, LETTERS, block).collect()}
    assert got == want
    tagged = {}
    for r in sorted(rg.tagged_ranges(ranges, ms_len, LETTERS, block).collect(), key=lambda r: r.pos):
        tagged[r.file_name] = tagged.get(r.file_name, "") + r.piece
    assert tagged == {r.file_name: r.tagged for r in ms.rebuild_text(whole).collect() if r.tagged}
    parts = [r.piece for r in ranges.collect()]
    assert chars == 10_000 or max(map(len, parts)) <= chars + 481


@pytest.fixture(scope="module")
def large_files(tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("large"), random.Random(2)
    head = "######Text#\n\n#META#Title: x\n#META#Header#End#\n\n\n"
    line = ["# و قال محمد ms01 بن عبد\n", "~~الله كان في  البيت ms002\n", "\n", "plain é 日本 😀 words here\n", "  \n"]
    bodies = {
        "0300Large.Text.L1-ara1": "".join(rng.choice(line) for _ in range(60_000)) + "last line\n \n\t",
        "0300Small.Text.S1-ara1": "نص قصير",
        "0300Empty.Text.E1-ara1": "\n \n",
    }
    files = {name: head + body for name, body in bodies.items()} | {"0300None.Text.N1-ara1": "no splitter\nat all"}
    for name, value in files.items():
        (root / name).write_text(value, encoding="utf8", newline="")
    (root / "readme.md").write_text("not a text")
    return root, files


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    yield
    spark.conf.set(name, before)


def test_one_file_gives_many_partitions(spark, large_files, small_splits):
    root, files = large_files
    pieces = readers.read_text_ranges(spark, str(root), chars=5000, exact=True)
    assert {"series", "part", "version"} <= set(pieces.columns)
    rows = pieces.collect()
    joined = {}
    for r in sorted(rows, key=lambda r: r.pos):
        joined[r.file_name] = joined.get(r.file_name, "") + r.piece
    assert joined == files
    assert len({(r.file_name, r.pos) for r in rows}) == len(rows)
    large = [r for r in rows if r.file_name.startswith("0300Large")]
    size = len(files["0300Large.Text.L1-ara1"].encode())
    assert readers.read_text_ranges(spark, str(root)).rdd.getNumPartitions() >= size // (256 << 10)
    assert max(len(r.piece) for r in large) < 5100


def test_large_file_as_a_whole_one(spark, large_files, small_splits, tmp_path):
    """From files: header cut, tags stripped, milestones and tagged text as from files in one row."""
    root, _ = large_files
    whole = ms.assign_milestones(ms.prepare_texts(readers.read_texts(spark, str(root))), 300).withColumn("start", F.lit(0).cast("bigint"))
    want = {(r.file_name, r.n): (r.ms_label, r.text) for r in ms.milestone_rows(whole).collect()}
    ranges = rg.strip_tags(rg.body_ranges(readers.read_text_ranges(spark, str(root), chars=3000).select("file_name", "pos", "piece")))
    got = {(r.file_name, r.n): (r.ms_label, r.text) for r in rg.milestone_rows(ranges).collect()}
    assert got == want and len([k for k in want if "Large" in k[0]]) > 300
    job = prepare.milestone_ranges(spark, str(root), str(tmp_path / "out"))
    tagged = sorted((r.pos, r.piece) for r in job.where("file_name like '%Large%'").collect())
    assert "".join(piece for _, piece in tagged) == ms.rebuild_text(whole).where("file_name like '%Large%'").first().tagged


def test_no_splitter_expected(spark):
    lines = spark.createDataFrame([("f", 0, "\n"), ("f", 10, " a b\n"), ("f", 11, "\n"), ("f", 20, "c \n"), ("f", 30, " \n"), ("g", 0, "\n")], "file_name string, pos bigint, piece string")
    rows = rg.body_ranges(lines, None).orderBy("file_name", "pos").collect()
    assert [(r.pos, r.piece) for r in rows] == [(0, "\n"), (10, " a b\n"), (11, "\n"), (20, "c")]
    assert rg.milestone_rows(rg.body_ranges(lines.limit(0))).collect() == []


def test_ranges_are_cut_once(spark):
    """The plan has one cut of the ranges; texts that are there twice give their whole milestones twice."""
    texts = spark.createDataFrame([("a", "one two three four five six seven")] * 2, "file_name string, body string")
    cut = rg.milestone_texts(rg.cut_ranges(rg.text_ranges(texts, 40), 2, r"\p{L}"))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\A(") == 1
    whole = spark.createDataFrame([("a", 0, k, k + 1, t, w) for k, (t, w) in enumerate([("x ", False), ("y ", True), ("y ", True), ("z", False)])],
                                  "file_name string, pos bigint, i int, n bigint, piece string, inner boolean")
    whole = whole.withColumn("n", F.when(F.col("n") == 3, 2).otherwise(F.col("n")))
    assert sorted((r.n, r.text) for r in rg.milestone_texts(whole).collect()) == [(1, "x "), (2, "y "), (2, "y "), (4, "z")]
