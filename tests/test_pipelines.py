"""Whole jobs on hand-made input, from files to files, against plain Python."""

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from spolia import schemas
from spolia.config import CorpusConfig
from spolia.operators import alignments as al, bookstats as bs, corpus, milestones as ms, pairwise as pw
from spolia.plans import pairwise as pairwise_plan, prepare, statistics as stats_plan
from spolia.sources import readers, writers
from tests.test_align import matched_chars, matched_words

HEAD = "######Text#\n\n#META#Header#End#\n\n"
FILES = {
    "0100One.Book.X1-eng1": "plain version",
    "0100One.Book.X1-eng1.inProgress": "alpha beta gamma delta epsilon ms1 zeta",
    "0100One.Book.X1-eng1.completed": "alpha beta. ms01 gamma! ms02 tail without tag",
    "0100One.Book.X1-ara1": "other language ms1",
    "0200Two.Long.X2A-eng1": "one two three ms1",
    "0200Two.Long.X2B-eng1": "four five ms2",
    "0300Three.Sec.X3-eng1": "secondary ms1",
    "0400Four.Empty.X4-eng1": "no tag at all",
    "readme.md": "not a text",
}
NO_SPLITTER = "0500Five.Bad.X5-eng1"


@pytest.fixture(scope="module")
def corpus_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for i, (name, body) in enumerate(FILES.items()):
        folder = root / f"d{i % 2}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(HEAD + body, encoding="utf8")
    (root / NO_SPLITTER).write_text("nothing here", encoding="utf8")
    meta = root.parent / f"{root.name}-meta.tsv"
    meta.write_text("id\tstatus\n" + "".join(f"X{i}\t{'sec' if i == 3 else 'pri'}\n" for i in range(1, 6)))
    return root, meta


def records_of(spark, path):
    return {(r.id, r.series, r.text, r.seq) for r in readers.read_records(spark, path).collect()}


def test_export_records(spark, corpus_dir, tmp_path):
    root, meta = corpus_dir
    out, log = str(tmp_path / "records"), str(tmp_path / "log")
    settings = CorpusConfig(chunk_rows=1)
    status = prepare.export_records(spark, str(root), out, log, str(meta), settings)
    # The normaliser drops Latin letters, so only the shape of the texts is left here.
    want = {
        ("X1-eng1.completed.ms01", "X1-eng1.completed", " ", 1),
        ("X1-eng1.completed.ms02", "X1-eng1.completed", " ", 2),
        ("X1-ara1.ms1", "X1-ara1", " ", 1),
        ("X2-eng1.ms1", "X2-eng1", " ", 1),
        ("X2-eng1.ms2", "X2-eng1", " ", 2),
    }
    assert records_of(spark, out) == want
    written = {p.name for p in (tmp_path / "records").iterdir() if p.is_dir()}
    assert written == {
        "file=X1-eng1.completed-00001", "file=X1-eng1.completed-00002", "file=X1-ara1-00001",
        "file=X2-eng1-00001", "file=X2-eng1-00002",
    }
    assert {tuple(r) for r in status.collect()} == {
        ("X1-eng1.completed", 1), ("X1-ara1", 1), ("X2-eng1", 1), ("X4-eng1", 1),
    }
    again = prepare.export_records(spark, str(root), out, log, str(meta), settings)
    assert {tuple(r) for r in again.collect()} == {
        ("X1-eng1.completed", 0), ("X1-ara1", 0), ("X2-eng1", 0), ("X4-eng1", 1),
    }
    assert records_of(spark, out) == want


def test_unfiltered_export_with_book_uri(spark, corpus_dir, tmp_path):
    root, _ = corpus_dir
    settings = CorpusConfig(primary_only=False, include_book_uri=True)
    prepare.export_records(spark, str(root), str(tmp_path / "r"), str(tmp_path / "l"), None, settings)
    got = {(r.id, r.book_uri) for r in readers.read_records(spark, str(tmp_path / "r")).collect()}
    assert ("X3-eng1.ms1", "0300Three.Sec") in got and len(got) == 6


def test_missing_splitter(spark, corpus_dir):
    bad = corpus.missing_splitter(readers.read_texts(spark, str(corpus_dir[0])))
    assert [r.file_name for r in bad.collect()] == [NO_SPLITTER]


def test_insert_milestones(spark, corpus_dir, tmp_path):
    out = str(tmp_path / "tagged")
    rejects = prepare.insert_milestones(spark, str(corpus_dir[0]), out, ms_len=2, token_class=r"\p{L}")
    assert [tuple(r) for r in rejects.collect()] == [(NO_SPLITTER, "missing splitter")]
    got = {r.file_name: r.value.rstrip("\n") for r in readers.read_milestoned(spark, out).collect()}
    assert len(got) == 8
    marker = "######Text#\n\n\n\n#META#Header#End#\n\n\n\n"
    assert got["0200Two.Long.X2A-eng1"] == marker + "one two msA1 three msA2"
    assert got["0200Two.Long.X2B-eng1"] == marker + "four five msB3"
    assert got["0100One.Book.X1-eng1.completed"] == marker + "alpha beta ms1. gamma! tail ms2 without tag ms3"


def test_bad_part_rejects_book(spark):
    rows = [("0200Two.Long.X2A-eng1", HEAD + "one mms1s2 two"), ("0200Two.Long.X2B-eng1", HEAD + "three"),
            ("0100One.Book.X1-eng1", HEAD + "four")]
    texts = spark.createDataFrame(rows, "file_name string, value string")
    from spolia.functions.uri import with_uri

    sound, rejects = ms.split_rejects(prepare.milestone_texts(with_uri(texts), 5, r"\p{L}"))
    assert [r.file_name for r in sound.collect()] == ["0100One.Book.X1-eng1"]
    assert {tuple(r) for r in rejects.collect()} == {
        ("0200Two.Long.X2A-eng1", "text changed"), ("0200Two.Long.X2B-eng1", "other part rejected"),
    }


# --- alignments -------------------------------------------------------------------------


def make_alignments(n=60, seed=11):
    """Rows over four books; milestones of book D have no record."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        a, b = sorted(rng.sample("ABCD", 2))
        s1 = "".join(rng.choice("ab c\n-") for _ in range(rng.randrange(0, 90)))
        s2 = "".join(c if rng.random() < 0.8 else rng.choice("ab -") for c in s1)
        if i == 0:
            a, b, s1, s2 = "A", "B", "aaaa", "bbbb"
        if i == 1:
            s2 = s1 + "x"
        row = dict(
            b1=rng.randrange(40), b2=rng.randrange(40), bw1=rng.randrange(9), bw2=rng.randrange(9),
            e1=0, e2=0, ew1=0, ew2=0, first1=1, first2=2, gid1=1, gid2=2,
            id1=f"{a}-eng1.ms{i}", id2=f"{b}-eng1.ms{i}", len1=9, len2=9, matches=rng.randrange(50),
            s1=s1, s2=s2, score=1.5, seq1=rng.randrange(1, 4), seq2=rng.randrange(1, 4),
            series1=f"{a}-eng1", series2=f"{b}-eng1", tok1=3, tok2=4, uid1=i, uid2=i + 1000,
        )
        rows.append(row)
    return rows


RECORDS = [
    dict(id=f"{b}-eng1.ms{k}", series=f"{b}-eng1", seq=k, text="t" * (10 * k + ord(b) % 7)) for b in "ABC" for k in (1, 2, 3)
]
META = [
    ("A", "100", "400", "300", "x", "300x.A"), ("B", "0", "500", "300", "x", "300x.B"), ("C", "", "600", "late", "z", "1z.C"),
]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("align")
    rows = make_alignments()
    dirty = rows + rows[:5] + [rows[7] | {"uid1": 777, "score": None}]
    (root / "align.json").mkdir()
    (root / "align.json" / "part.json").write_text("\n".join(json.dumps(r) for r in dirty))
    df = spark.createDataFrame([tuple(r[f.name] for f in schemas.ALIGNMENTS.fields) for r in dirty], schemas.ALIGNMENTS)
    df.write.parquet(str(root / "align.parquet"))
    (root / "records").mkdir()
    (root / "records" / "r.json").write_text("\n".join(json.dumps(r) for r in RECORDS))
    header = "id\ttok_length\tchar_length\tdate\tauthor_lat\tbook\n"
    (root / "meta.tsv").write_text(header + "".join("\t".join(m) + "\n" for m in META))
    return root, [r for r in rows if len(r["s1"]) == len(r["s2"])]


def brute_stats(rows, compat, mode):
    offsets = {}
    for book in "ABC":
        total = 0
        for r in [r for r in RECORDS if r["series"] == f"{book}-eng1"]:
            total += len(r["text"])
            offsets[book, r["seq"]] = total - (len(r["text"]) if mode == "exclusive" else 0)
    out = {}
    for r in rows:
        books = [r[f"series{s}"][0] for s in (1, 2)]
        if "D" in books:
            continue
        sides = [r[f"s{s}"].replace("\n", " ") for s in (1, 2)]
        sets, matches = out.setdefault(tuple(books), ([set() for _ in range(4)], []))
        matches.append(r["matches"])
        for s in (0, 1):
            words = {(r[f"seq{s + 1}"] - 1) * 300 + r[f"bw{s + 1}"] + k for k in matched_words(sides[s], sides[1 - s])}
            chars = {offsets[books[s], r[f"seq{s + 1}"]] + r[f"b{s + 1}"] + i for i in matched_chars(*sides)}
            for target, found in ((sets[s], words), (sets[2 + s], chars)):
                target |= found or ({"none"} if compat else set())
    return {
        k: (len(m), *[len(s) for s in sets], min(m), max(m), statistics.mean(m)) for k, (sets, m) in out.items()
    }


@pytest.mark.parametrize("compat,mode,kernel", [(True, "inclusive", "builtin"), (False, "exclusive", "arrow")])
def test_book_pair_stats(spark, inputs, compat, mode, kernel):
    root, rows = inputs
    stats = bs.book_pair_stats(
        readers.read_alignments(spark, str(root / "align.parquet")), readers.read_records(spark, str(root / "records")),
        readers.read_metadata(spark, str(root / "meta.tsv")), 300, mode, compat, kernel,
    )
    assert tuple(stats.columns) == schemas.BOOK_STATS_COLUMNS
    got = stats.collect()
    assert {
        (r._T1, r._T2): (r.instances, r.WM1_Total, r.WM2_Total, r.CM1_Total, r.CM2_Total,
                         r.ch_MATCHES_Min, r.ch_MATCHES_Max, r.ch_MATCHES_Mean)
        for r in got
    } == brute_stats(rows, compat, mode)
    ab = next(r for r in got if (r._T1, r._T2) == ("A", "B"))
    assert ab.WM_B1inB2 == ab.WM1_Total / 100 and ab.WM_B2inB1 is None and ab.CM_B2inB1 == ab.CM2_Total / 500
    assert (ab.chrono_B1B2, ab.chrono_B2B1) == ("sr_include", "sr_exclude")


def test_statistics_with_a_milestone_that_everything_quotes(spark):
    """A third of all alignments share one milestone, and half of those are written twice."""
    rows = []
    for i, r in enumerate(make_alignments(240)):
        if len(r["s1"]) != len(r["s2"]) or "D" in (r["series1"][0], r["series2"][0]):
            continue
        r = r | (dict(series1="A-eng1", series2="B-eng1", seq1=2, seq2=1) if i % 3 == 0 else {})
        rows.append(r)
    doubled = rows + [r for i, r in enumerate(rows) if i % 6 == 0]
    same = [r | {"score": 2.5} for r in rows[:9]]  # another alignment of the same passage counts
    df = spark.createDataFrame([tuple(r[f.name] for f in schemas.ALIGNMENTS.fields) for r in doubled + same], schemas.ALIGNMENTS)
    records = spark.createDataFrame(RECORDS, "id string, series string, seq bigint, text string")
    meta = spark.createDataFrame(META, "id string, tok_length string, char_length string, date string, author_lat string, book string")
    stats = bs.book_pair_stats(df.repartition(6), records, meta)
    got = {(r._T1, r._T2): (r.instances, r.WM1_Total, r.WM2_Total, r.CM1_Total, r.CM2_Total,
                            r.ch_MATCHES_Min, r.ch_MATCHES_Max, r.ch_MATCHES_Mean) for r in stats.collect()}
    assert got == brute_stats(rows + same, True, "inclusive")
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "marks" in plan
    # the texts end where they are compared: nothing above the grouping by digest knows them
    above = plan.split("Aggregate [_T1")[1].split("\n")[0]
    assert "s1#" not in above and "s2#" not in above


def test_book_statistics_files(spark, inputs, tmp_path):
    root, rows = inputs
    for single in (True, False):
        out = str(tmp_path / f"stats{single}")
        stats_plan.book_statistics(
            spark, str(root / "records"), str(root / "align.json"), str(root / "meta.tsv"), out, single_file=single
        )
        back = spark.read.csv(out, sep="\t", header=True)
        assert tuple(back.columns) == schemas.BOOK_STATS_COLUMNS
        pairs = [(r._T1, r._T2) for r in back.collect()]
        files = [p.name for p in (tmp_path / f"stats{single}").iterdir() if not p.name.startswith((".", "_"))]
        if single:
            assert files == ["part-00000.csv.gz"] and pairs == sorted(pairs)
            assert [p.name for p in tmp_path.iterdir() if "members" in p.name] == []
        assert back.count() == len(brute_stats(rows, True, "inclusive"))
    report = stats_plan.data_quality(spark, str(root / "records"), str(root / "align.json"))
    assert report["unequal"].count() == 1 and report["shared"].count() == 0
    assert report["lost"].count() == sum("D-eng1" in (r["series1"], r["series2"]) for r in rows)


def test_duplicate_metadata_fails(spark, inputs):
    meta = readers.read_metadata(spark, str(inputs[0] / "meta.tsv"))
    with pytest.raises(Exception, match="duplicate metadata id"):
        bs.unique_metadata(meta.union(meta)).collect()


def test_pairwise_files(spark, inputs, tmp_path):
    root, rows = inputs
    one, two, mirrored = (str(tmp_path / n) for n in ("one", "two", "mirrored"))
    unequal = pairwise_plan.pairwise_tables(spark, str(root / "align.json"), one)
    assert unequal.count() == 1
    pairwise_plan.pairwise_tables(spark, str(root / "align.parquet"), two, both_directions=True)
    pairwise_plan.mirror_tables(spark, one, mirrored)
    back, both, again = (readers.read_pairwise(spark, p) for p in (one, two, mirrored))
    assert tuple(c for c in back.columns if not c.startswith("series") or "_" in c) == schemas.PAIRWISE_COLUMNS
    assert {(r.uid1, r.s1, r.s2, r.w_match) for r in back.collect()} == {
        (r["uid1"], r["s1"], r["s2"], len(matched_words(r["s1"], r["s2"]))) for r in rows
    }
    columns = sorted(both.columns)
    as_set = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert both.count() == 2 * len(rows) and as_set(both) == as_set(again)
    flipped_twice = pw.flip(pw.flip(back))
    assert as_set(flipped_twice) == as_set(back)
    for folder in (tmp_path / "one").glob("series1=*/series2=*"):
        for part in folder.glob("part-*"):
            ids = [(r.id1, r.id2) for r in readers.read_tsv(spark, str(part), escaped=True).select("id1", "id2").collect()]
            assert ids == sorted(ids)


CELLS = ["a\nb", "a\rb", "a\r\nb", "\\n", "\\\\n", "\\", "\\\\", "x\\\n", 'q"u\t"', "", " ", "\u2028 \u0085", "\\r\\", "\n", None, "plain"]


@pytest.mark.parametrize("escape", [True, False])
def test_pairwise_cells_survive(spark, tmp_path, escape):
    rows = [("A", "B", f"a{k:02}", "b", k, cell, "x" if cell is None else cell) for k, cell in enumerate(CELLS)]
    df = spark.createDataFrame(rows, "series1 string, series2 string, id1 string, id2 string, b1 int, s1 string, s2 string")
    out = str(tmp_path / "out")
    writers.write_pairwise(df, out, escape)
    files = [p.name for p in (tmp_path / "out").glob("*/*/part-*")]
    assert files and all(name.endswith(".tsv" if escape else ".csv") for name in files)
    back = readers.read_pairwise(spark, out).select(*df.columns)
    assert sorted((*r[:5], r.s1 or "", r.s2) for r in back.collect()) == sorted((*r[:5], r[5] or "", r[6]) for r in rows)


def test_pairwise_files_are_split(spark, tmp_path):
    """A table with escaped cells is read by several tasks, line breaks or not."""
    df = spark.range(20000).select(
        *[F.lit(x).alias(c) for c, x in (("series1", "A"), ("series2", "B"))], *[F.format_string("i%06d", "id").alias(c) for c in ("id1", "id2")],
        F.lit("two\nlines \\ " * 10).alias("s1"),
    )
    out = str(tmp_path / "out")
    writers.write_pairwise(df.coalesce(1), out)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        back = readers.read_pairwise(spark, out)
        files = len(list((tmp_path / "out").glob("*/*/part-*")))
        assert back.rdd.getNumPartitions() > 4 * files
        assert back.select("id1", "s1").exceptAll(df.select("id1", "s1")).isEmpty() and back.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_of_a_frequent_pair_follow_each_other(spark, tmp_path):
    """One pair beyond the advisory size: its files do not overlap and are of like size."""
    many = spark.range(40000).select(F.lit("A").alias("series1"), F.lit("B").alias("series2"), "id")
    few = spark.range(200).select(F.concat(F.lit("C"), F.col("id") % 50).alias("series1"), F.lit("D").alias("series2"), "id")
    rows = many.union(few).select(
        "series1", "series2", F.format_string("i%08d", F.pmod(F.xxhash64("id"), F.lit(10**8))).alias("id1"),
        F.format_string("j%08d", F.pmod(F.hash("id"), F.lit(10**7))).alias("id2"), F.repeat(F.lit("x"), F.lit(40)).alias("s1"),
    )
    out = str(tmp_path / "out")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100000"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        writers.write_pairwise(rows, out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    parts = sorted((tmp_path / "out" / "series1=A" / "series2=B").glob("part-*"))
    ids = [[tuple(line.split("\t")[:2]) for line in p.read_text().splitlines()[1:]] for p in parts]
    assert len(parts) > 4 and sum(map(len, ids)) == 40000
    assert [i for part in ids for i in part] == sorted(i for part in ids for i in part)
    inner = [len(part) for part in ids[:-1]]  # the last one may share its range with other pairs
    assert max(map(len, ids)) <= 2 * sum(inner) / len(inner)


def test_alignments_without_header(spark, tmp_path):
    rows = make_alignments(6)
    df = spark.createDataFrame([tuple(r[f.name] for f in schemas.ALIGNMENTS.fields) for r in rows], schemas.ALIGNMENTS)
    path = str(tmp_path / "a.csv")
    df.write.csv(path)
    back = readers.read_alignments(spark, path, columns=schemas.ALIGNMENTS.names)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_reads_only_present_columns(spark, tmp_path):
    rows = [{k: v for k, v in r.items() if not k.startswith("first")} for r in make_alignments(5)]
    path = tmp_path / "a.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    df = readers.read_alignments(spark, str(path))
    assert "first1" not in df.columns and al.clean_alignments(df).count() == 5
    path.write_text("\n".join(json.dumps({k: v for k, v in r.items() if k != "s1"}) for r in rows))
    with pytest.raises(ValueError, match="lack s1"):
        readers.read_alignments(spark, str(path))


def test_offsets_cross_blocks(spark):
    rng = random.Random(5)
    rows = [("S", k, "x" * rng.randrange(0, 9)) for k in rng.sample(range(1, 4000), 500)]
    df = spark.createDataFrame(rows, "series string, seq long, text string")
    got = {r.seq: r.ch_offset for r in bs.milestone_offsets(df, block=16).collect()}
    total, want = 0, {}
    for _, k, text in sorted(rows, key=lambda r: r[1]):
        total += len(text)
        want[k] = total
    assert got == want


def test_offsets_read_records_once(spark, tmp_path):
    path = str(tmp_path / "records")
    spark.range(1000).selectExpr("concat('S', id % 3) series", "id seq", "repeat('x', 5) text").write.parquet(path)
    offsets = bs.milestone_offsets(spark.read.parquet(path))
    offsets.collect()
    plan = offsets._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1


def test_choosing_versions_runs_no_job(spark):
    from spolia.functions.uri import with_uri

    texts = with_uri(spark.createDataFrame([("0100One.Book.X1-eng1", "x")], "file_name string, value string"))
    status = spark.sparkContext.statusTracker()
    before = len(status.getJobIdsForGroup(None))
    corpus.select_version(texts)
    assert len(status.getJobIdsForGroup(None)) == before


def write_texts(root, texts):
    for name, value in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(value, encoding="utf8")


def test_a_broken_part_rejects_its_book_in_the_export(spark, tmp_path):
    body = "ا ms1"
    write_texts(tmp_path / "in", {
        "0200Two.Long.X2A-eng1": HEAD + body, "0200Two.Long.X2B-eng1": body, "0200Two.Long.X2C-eng1": HEAD + body,
        "0100One.Book.X1-eng1": HEAD + body,
    })
    out, log, rejects = (str(tmp_path / n) for n in ("out", "log", "rejects"))
    settings = CorpusConfig(primary_only=False)
    status = prepare.export_records(spark, str(tmp_path / "in"), out, log, None, settings, rejects)
    assert {r.id for r in readers.read_records(spark, out).collect()} == {"X1-eng1.ms1"}
    assert [tuple(r) for r in status.collect()] == [("X1-eng1", 1)]
    assert {(r.file_name[-7:], r.reason) for r in spark.read.parquet(rejects).collect()} == {
        ("X2A-eng1"[-7:], "other part rejected"), ("X2B-eng1"[-7:], "missing splitter"), ("X2C-eng1"[-7:], "other part rejected"),
    }


@pytest.mark.parametrize("by_folder, reason", [(False, "same name in another folder"), (True, "version in another folder")])
def test_equal_names_in_two_folders(spark, tmp_path, by_folder, reason):
    names = ("0100One.Book.X2-eng1", "0300Three.Long.X3A-eng1", "0300Three.Long.X3B-eng1")
    write_texts(tmp_path / "in", {f"{d}/{n}": HEAD + f"ا {d} ms1" for d in "xy" for n in names})
    out, log, rejects = (str(tmp_path / n) for n in ("out", "log", "rejects"))
    settings = CorpusConfig(primary_only=False, by_folder=by_folder)
    prepare.export_records(spark, str(tmp_path / "in"), out, log, None, settings, rejects)
    ids = [r.id for r in readers.read_records(spark, out).collect()]
    assert sorted(ids) == ["X2-eng1.ms1", "X3-eng1.ms1", "X3-eng1.ms1"]  # parts A and B have a first milestone each
    found = spark.read.parquet(rejects).collect()
    assert {(r.path.split("/")[-2], r.file_name, r.reason) for r in found} == {("y", n, reason) for n in names}


def test_flat_records_grow_by_series(spark, tmp_path):
    source, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    settings = CorpusConfig(primary_only=False)
    write_texts(source, {"0100One.Book.X1-eng1": HEAD + "ا ms1"})
    prepare.export_records(spark, str(source), out, log, None, settings, per_series=False)
    first = {p.name for p in (tmp_path / "out").glob("part-*")}
    write_texts(source, {"0200Two.Book.X2-eng1": HEAD + "ا ms1"})
    again = prepare.export_records(spark, str(source), out, log, None, settings, per_series=False)
    assert {tuple(r) for r in again.collect()} == {("X1-eng1", 0), ("X2-eng1", 1)}
    assert sorted(r.id for r in readers.read_records(spark, out).collect()) == ["X1-eng1.ms1", "X2-eng1.ms1"]
    assert first <= {p.name for p in (tmp_path / "out").glob("part-*")}


@pytest.mark.parametrize("both", [False, True])
def test_repeated_rows_are_found_in_the_writing_shuffle(spark, both):
    """One pair with most rows, rows that repeat, differ in one column only, or have nulls or unequal sides."""
    rows = [r | {"uid1": k} for k, r in enumerate(make_alignments(8) * 5)]
    rows = rows + rows[::2] + [rows[0] | {"score": 0.25}, rows[1] | {"score": None}, rows[2] | {"s1": rows[2]["s1"] + "x"}] * 2
    df = spark.createDataFrame([tuple(r[f.name] for f in schemas.ALIGNMENTS.fields) for r in rows], schemas.ALIGNMENTS)
    usable, _ = al.split_unequal(al.clean_alignments(df))
    stats = al.alignment_stats(usable)
    want = pw.bidirectional(stats) if both else stats
    got = pairwise_plan.pairwise_rows(df, both)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    sorted_rows = got.sortWithinPartitions(*al.PLACE)
    plan = sorted_rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning(series1" in plan
    assert pairwise_plan.pairwise_rows(df.limit(0), both).isEmpty()


def test_mirror_twice(spark, tmp_path):
    df = spark.createDataFrame([("A", "B", "a1", "b1", 1), ("A", "B", "a2", "b1", 2), ("C", "A", "c1", "a1", 3)],
                               "series1 string, series2 string, id1 string, id2 string, matches int")
    once = pw.bidirectional(df)
    assert sorted(pw.bidirectional(pw.one_direction(once)).collect()) == sorted(once.collect())
    assert sorted(pw.one_direction(df).collect()) == sorted(df.collect())


def test_values_that_do_not_fit_are_reported(spark, tmp_path):
    row = next(r for r in make_alignments() if len(r["s1"]) == len(r["s2"]))
    rows = [row, row | {"uid1": 501, "matches": 3.0}, row | {"uid1": 502, "b1": 2**31}, row | {"uid1": 503, "gid1": 2**63 + 5}]
    (tmp_path / "a.json").mkdir()
    (tmp_path / "a.json" / "p.json").write_text("\n".join(json.dumps(r) for r in rows))
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    pairwise_plan.pairwise_tables(spark, str(tmp_path / "a.json"), out, rejects_path=rejects)
    assert {r.uid1 for r in readers.read_pairwise(spark, out).collect()} == {row["uid1"], 501}
    assert {(r.uid1, r._misfit) for r in spark.read.json(rejects).collect()} == {(502, "b1"), (503, "gid1")}


def test_corrupt_records_are_left_out(spark):
    rows = [tuple(r[f.name] for f in schemas.ALIGNMENTS.fields) for r in make_alignments(4)]
    df = spark.createDataFrame(rows, schemas.ALIGNMENTS)
    marked = df.withColumn("_corrupt_record", F.lit(None).cast("string"))
    assert al.clean_alignments(marked).count() == df.distinct().count()


def test_book_statistics_are_ordered(spark, inputs, tmp_path):
    root, rows = inputs
    out = str(tmp_path / "stats")
    stats_plan.book_statistics(spark, str(root / "records"), str(root / "align.parquet"), str(root / "meta.tsv"), out, single_file=True)
    got = spark.read.csv(out, sep="\t", header=True).collect()
    keys = [(r._T1, r._T2) for r in got]
    assert keys == sorted(keys) and len(keys) > 2
    want = brute_stats(rows, True, "inclusive")
    assert {(r._T1, r._T2) for r in got} == {(a[0], b[0]) for a, b in want} or len(got) == len(want)


def test_alignments_are_compared_in_arrow(spark, tmp_path):
    """The input of the alignment queries: compared once in batches, with the matches that the built-in expressions give."""
    from checks import tables
    from spolia.functions import align

    texts = ["same first\na b  c\n\nlong line é𝄞 here\n", "same first\na x  c\n\nlong lime é𝄞 there and on", "same first", None, "", "alone"]
    rows = [(k, t, f"src{k % 3}") for k, t in enumerate(texts * 2)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    df = tables.alignments(spark, str(tmp_path))
    assert "ArrowEvalPython" in df._jdf.queryExecution().toString()
    assert dict(df.dtypes)["matches"] == "int"
    got = df.select("matches", align.ch_match(F.col("s1"), F.col("s2"), exclude_spaces=False).alias("plain")).collect()
    assert len(got) > 10 and any(r.matches for r in got) and all(r.matches == r.plain for r in got)
