"""Expressions on aligned passages.

Both strings of an alignment have the same length.  They are compared character by
character exactly once, by `diff_mask`; every other figure is read off the mask.
"""

from __future__ import annotations

from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import Column

# Mask symbols: 1 equal, 0 different, ' ' blank in both, p / q blank in side 1 / 2 only.
# Digits and blanks are what the bit strings below need, so most symbols stay as they are.
_WORD_BITS = 64


def diff_mask(s1: Column, s2: Column, kernel: str = "builtin") -> Column:
    """One symbol per aligned character: `1`, `0`, ` `, `p` or `q` (see above).

    Null unless both strings have the same length.  `kernel="arrow"` does the comparison
    on whole Arrow batches; it gives the same mask and suits very large alignment tables.
    """
    same_length = F.length(s1) == F.length(s2)
    if kernel == "arrow":
        from spolia.functions.arrow_kernel import compare

        return F.when(same_length, compare()(s1, F.when(same_length, s2).otherwise(s1)))
    if kernel != "builtin":
        raise ValueError(f"unknown kernel {kernel!r}")
    symbols = F.zip_with(
        F.split(s1, ""),
        F.split(s2, ""),
        lambda x, y: F.when(x == y, F.when(x == " ", x).otherwise("1"))
        .when(x == " ", "p")
        .when(y == " ", "q")
        .otherwise("0"),
    )
    # Splitting an empty string gives one empty element, hence the extra branch.
    return F.when(same_length, F.when(s1 == "", "").otherwise(F.array_join(symbols, "")))


def _replace(text: Column, symbols: dict[str, str]) -> Column:
    for old, new in symbols.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def char_bits(mask: Column) -> Column:
    """`1` where the characters are equal (blanks included), else `0`."""
    return _replace(mask, {" ": "1", "p": "0", "q": "0"})


def word_bits(mask: Column, side: int = 1) -> Column:
    """One digit per blank-separated word of a side: `1` if all of it is matched.

    A word between two adjacent blanks is empty and counts as matched; a blank at the
    very end does not open another word.
    """
    if side not in (1, 2):
        raise ValueError("side must be 1 or 2")
    plain = _replace(mask, {"p": " ", "q": "0"} if side == 1 else {"q": " ", "p": "0"})
    # Close the last word unless a blank does; an empty alignment has none.
    closed = F.regexp_replace(plain, "(?<=[01])\\z", " ")
    # Anchored at word starts, so that a long matched word is not searched from every letter.
    broken = F.regexp_replace(closed, "(?<![01])1*+0[01]*+ ", "x")
    return _replace(F.regexp_replace(broken, "1*+ ", "y"), {"x": "0", "y": "1"})


def ch_match_of(mask: Column, exclude_spaces: bool = True) -> Column:
    return F.length(F.regexp_replace(mask, "[^1]++" if exclude_spaces else "[^1 ]++", ""))


def w_match_of(mask: Column, side: int = 1) -> Column:
    return F.length(F.replace(word_bits(mask, side), F.lit("0"), F.lit("")))


def counts(s1: Column, s2: Column, kernel: str = "arrow") -> Column:
    """`struct<ch, ch_all, w1, w2>`: equal characters without and with blanks, matched words of either side.

    One comparison gives all four; null unless both strings have the same length.
    """
    if kernel == "arrow":
        from spolia.functions import arrow_kernel

        same_length = F.length(s1) == F.length(s2)
        return F.when(same_length, arrow_kernel.counts()(s1, F.when(same_length, s2).otherwise(s1)))
    return _of_mask(diff_mask(s1, s2, kernel), _counts_of)


def _of_mask(mask: Column, figures: Callable[[Column], list[Column]]) -> Column:
    """A struct of figures of a mask that is computed once; null where the mask is."""
    return F.transform(F.array(mask), lambda m: F.when(m.isNotNull(), F.struct(*figures(m))))[0]


def _counts_of(mask: Column) -> list[Column]:
    return [
        ch_match_of(mask).alias("ch"), ch_match_of(mask, False).alias("ch_all"),
        w_match_of(mask).alias("w1"), w_match_of(mask, 2).alias("w2"),
    ]


def marks(s1: Column, s2: Column, kernel: str = "arrow") -> Column:
    """`counts`, and `chars`, `words1`, `words2`: the matched characters and words as `bit_words`.

    A line break counts as a blank.  A passage of n characters leaves n / 8 bytes of marks.
    """
    if kernel == "arrow":
        from spolia.functions import arrow_kernel

        same_length = F.length(s1) == F.length(s2)
        return F.when(same_length, arrow_kernel.marks(newlines=True)(s1, F.when(same_length, s2).otherwise(s1)))
    return _of_mask(diff_mask(newline_to_space(s1), newline_to_space(s2), kernel), lambda m: _counts_of(m) + _sets_of(m))


def _sets_of(mask: Column) -> list[Column]:
    return [bit_words(char_bits(mask)).alias("chars"), *[bit_words(word_bits(mask, s)).alias(f"words{s}") for s in (1, 2)]]


def bit_words(bits: Column) -> Column:
    """A string of digits as `array<bigint>`: digit i is bit i % 64, from the least on, of element i / 64."""
    return F.transform(
        F.regexp_extract_all(bits, F.lit(".{1,64}"), 0), lambda digits: F.conv(F.reverse(digits), 2, -10).cast("bigint")
    )


def placed_words(words: Column, first: Column) -> Column:
    """`bit_words` that begin at position `first`, as words of absolute positions: see `packed_positions`.

    Bit i stands for position `first + i`; position p is bit p % 64 of the word `p div 64`.
    """
    shift = F.pmod(first, F.lit(_WORD_BITS)).cast("int")
    base = F.shiftright(first, 6)
    open_end = F.concat(words, F.array(F.lit(0).cast("bigint")))

    def placed(word: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(words, i - 1)).otherwise(F.lit(0).cast("bigint"))
        carried = F.when(shift > 0, F.call_function("shiftrightunsigned", before, _WORD_BITS - shift)).otherwise(F.lit(0).cast("bigint"))
        return F.struct(
            (base + i.cast("bigint")).alias("word"), F.call_function("shiftleft", word, shift).bitwiseOR(carried).alias("bits")
        )

    return F.filter(F.transform(open_end, placed), lambda w: w["bits"] != 0)


def ch_match(s1: Column, s2: Column, exclude_spaces: bool = True, kernel: str = "builtin") -> Column:
    """Number of equal characters of an alignment, blanks left out on request."""
    return ch_match_of(diff_mask(s1, s2, kernel), exclude_spaces)


def w_match(s1: Column, s2: Column, kernel: str = "builtin") -> Column:
    """Number of words of `s1` that `s2` repeats exactly at the same place."""
    return w_match_of(diff_mask(s1, s2, kernel))


def align_len(s1: Column) -> Column:
    return F.length(s1)


def matches_percent(matches: Column, length: Column) -> Column:
    """Share of matched characters in percent, single precision carried in a double."""
    share = (matches / F.when(length != 0, length)) * 100
    return F.when(length == 0, F.lit(0.0)).otherwise(share.cast("float").cast("double"))


def newline_to_space(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def _set_positions(bits: Column, first: Column) -> Column:
    return F.array_compact(
        F.transform(
            F.split(bits, ""), lambda digit, i: F.when(digit == "1", first + i.cast("bigint"))
        )
    )


def word_positions(
    s1: Column, s2: Column, bw: Column, seq: Column, ms_len: int = 300, kernel: str = "builtin"
) -> Column:
    """Positions in the book of the matched words of side 1, `array<bigint>`."""
    return _set_positions(word_bits(diff_mask(s1, s2, kernel)), first_word(seq, bw, ms_len))


def char_positions(
    s1: Column, s2: Column, b: Column, offset: Column, kernel: str = "builtin"
) -> Column:
    """Positions in the book of the matched characters, blanks included, `array<bigint>`."""
    return _set_positions(char_bits(diff_mask(s1, s2, kernel)), offset.cast("bigint") + b)


def first_word(seq: Column, bw: Column, ms_len: int = 300) -> Column:
    """Position in the book of the first word of an alignment."""
    return (seq.cast("bigint") - 1) * ms_len + bw.cast("bigint") + 1


def packed_positions(bits: Column, first: Column) -> Column:
    """The set digits of `bits` as 64-bit words: `array<struct<word bigint, bits bigint>>`.

    Digit `i` stands for position `first + i`; position `p` lies in word `p div 64`.  Sets
    packed this way are united with `bit_or` per word and counted with `bit_count`, so a
    passage costs a row per 64 positions instead of one per position.
    """
    start = F.pmod(first, F.lit(_WORD_BITS)).cast("int")
    word = F.shiftright(first, 6)
    padded = F.concat(F.repeat(F.lit("0"), start), bits)
    packed = F.transform(
        F.regexp_extract_all(padded, F.lit(".{1,64}"), 0),
        lambda digits, i: F.struct(
            (word + i.cast("bigint")).alias("word"),
            F.conv(F.rpad(digits, _WORD_BITS, "0"), 2, -10).cast("bigint").alias("bits"),
        ),
    )
    return F.filter(packed, lambda w: w["bits"] != 0)


def count_dashes(text: Column) -> Column:
    """Number of gap characters."""
    return F.regexp_count(text, F.lit("-"))


def first_token(text: Column) -> Column:
    return F.substring_index(text, " ", 1)


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")
