"""Alignment expressions against a plain Python statement of their meaning."""

import random

import pytest
from pyspark.sql import functions as F

from spolia.functions import align

SAMPLE = ("the grey cat--- sat on my mat-- all day", "the gray cats-- sat in my mats- all dat")  # 34 of 39 characters match


def words(text):
    """(start, end) of every blank-separated word, without one opened by a final blank."""
    start, out = 0, []
    for piece in text.split(" "):
        out.append((start, start + len(piece)))
        start += len(piece) + 1
    return out[:-1] if text == "" or text.endswith(" ") else out


def matched_words(s1, s2):
    return [k for k, (i, j) in enumerate(words(s1), 1) if s1[i:j] == s2[i:j]]


def matched_chars(s1, s2):
    return [i for i in range(len(s1)) if s1[i] == s2[i]]


def random_pairs(n=200, seed=7):
    rng = random.Random(seed)
    out = [SAMPLE, ("a  b ", "a xb "), (" a", " a"), ("", ""), (" ", " "), ("  ", " x"), ("x", "y"), ("a ", "ab")]
    for _ in range(n):
        s1 = "".join(rng.choice("ab  -نé\n") for _ in range(rng.randrange(0, 200)))
        s2 = "".join(c if rng.random() < 0.85 else rng.choice("ab -") for c in s1)
        out.append((s1, s2))
    return out


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(random_pairs())]
    return spark.createDataFrame(rows, "i int, s1 string, s2 string").repartition(4).cache()


@pytest.mark.parametrize("kernel", ["builtin", "arrow"])
def test_counts_and_positions(pairs, kernel):
    s1, s2 = F.col("s1"), F.col("s2")
    rows = pairs.select(
        "s1", "s2",
        align.ch_match(s1, s2, True, kernel).alias("ch"),
        align.ch_match(s1, s2, False, kernel).alias("ch_all"),
        align.w_match(s1, s2, kernel).alias("w"),
        align.word_positions(s1, s2, F.lit(4), F.lit(3), 300, kernel).alias("wp"),
        align.char_positions(s1, s2, F.lit(4), F.lit(100), kernel).alias("cp"),
    ).collect()
    assert len(rows) == len(random_pairs())
    for r in rows:
        chars = matched_chars(r.s1, r.s2)
        assert r.ch == len([i for i in chars if r.s1[i] != " "])
        assert r.ch_all == len(chars)
        assert r.w == len(matched_words(r.s1, r.s2))
        assert r.wp == [600 + 4 + k for k in matched_words(r.s1, r.s2)]
        assert r.cp == [104 + i for i in chars]


def test_other_side_of_mask(pairs):
    mask = align.diff_mask(F.col("s1"), F.col("s2"))
    for r in pairs.select("s1", "s2", align.w_match_of(mask, 2).alias("w")).collect():
        assert r.w == len(matched_words(r.s2, r.s1))


@pytest.mark.parametrize("kernel", ["builtin", "arrow"])
def test_counts_in_one_comparison(pairs, kernel):
    rows = pairs.select("s1", "s2", align.counts(F.col("s1"), F.col("s2"), kernel).alias("c")).collect()
    for r in rows:
        chars = matched_chars(r.s1, r.s2)
        plain = len([i for i in chars if r.s1[i] != " "]), len(chars), len(matched_words(r.s1, r.s2)), len(matched_words(r.s2, r.s1))
        assert tuple(r.c) == plain


def unpacked(words, first=0):
    return [first + 64 * k + i for k, w in enumerate(words) for i in range(64) if w >> i & 1]


@pytest.mark.parametrize("kernel", ["builtin", "arrow"])
def test_marks(pairs, kernel):
    """Line breaks are blanks; the bits begin at the passage and are moved to their places."""
    for first in (0, 1, 63, 64, 1000, -5):
        marks = pairs.select("s1", "s2", align.marks(F.col("s1"), F.col("s2"), kernel).alias("m"))
        rows = marks.select("*", align.placed_words(F.col("m.chars"), F.lit(first).cast("bigint")).alias("p")).collect()
        for r in rows:
            a, b = r.s1.replace("\n", " "), r.s2.replace("\n", " ")
            assert unpacked(r.m.chars) == matched_chars(a, b)
            assert unpacked(r.m.words1) == [k - 1 for k in matched_words(a, b)]
            assert unpacked(r.m.words2) == [k - 1 for k in matched_words(b, a)]
            assert (r.m.ch_all, r.m.w1, r.m.w2) == (len(matched_chars(a, b)), len(matched_words(a, b)), len(matched_words(b, a)))
            assert [x for w in r.p for x in unpacked([w.bits], 64 * w.word)] == [first + i for i in matched_chars(a, b)]


def test_unequal_and_missing_sides_have_no_marks(spark):
    df = spark.createDataFrame([("ab", "abc"), (None, "a"), (None, None), ("a", "a")], "s1 string, s2 string")
    for kernel in ("builtin", "arrow"):
        rows = df.select(align.counts(F.col("s1"), F.col("s2"), kernel).alias("c"), align.marks(F.col("s1"), F.col("s2"), kernel).alias("m")).collect()
        assert [r.c is None and r.m is None for r in rows] == [True, True, True, False]


def test_packed_positions(pairs):
    mask = align.diff_mask(F.col("s1"), F.col("s2"))
    for first in (0, 1, 63, 64, 1000, -5):
        packed = align.packed_positions(align.char_bits(mask), F.lit(first).cast("bigint"))
        for r in pairs.select("s1", "s2", packed.alias("p")).collect():
            got = [
                w.word * 64 + k
                for w in r.p
                for k, digit in enumerate(format(w.bits % 2**64, "064b"))
                if digit == "1"
            ]
            assert got == [first + i for i in matched_chars(r.s1, r.s2)]


def test_fixed_examples(spark):
    s1, s2 = F.lit(SAMPLE[0]), F.lit(SAMPLE[1])
    row = spark.range(1).select(
        align.w_match(s1, s2), align.ch_match(s1, s2), align.ch_match(s1, s2, False),
        align.align_len(s1), align.matches_percent(F.lit(34), F.lit(39)),
        align.matches_percent(F.lit(21), F.lit(0)), align.count_dashes(s1),
        align.first_token(s1), align.ascii_only(F.lit("aéب-b")),
        align.diff_mask(F.lit("is"), F.lit("island")),
    ).first()
    assert tuple(row) == (4, 26, 34, 39, 87.17948913574219, 0.0, 5, "the", "a-b", None)
