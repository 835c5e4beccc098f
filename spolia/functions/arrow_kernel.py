"""Arrow versions of the comparison of aligned passages, see `align`.

All strings of a batch are laid end to end and compared at once; counts per passage are sums over its stretch, and the
positions that match are packed into 64-bit words, least bit first.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

COUNTS = "struct<ch:int,ch_all:int,w1:int,w2:int>"
MARKS = "struct<ch:int,ch_all:int,w1:int,w2:int,chars:array<bigint>,words1:array<bigint>,words2:array<bigint>>"


def points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all strings end to end, and n + 1 offsets; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    starts = (flat & 0xC0) != 0x80
    if starts.all():
        return flat, offsets
    before = np.concatenate([[0], np.cumsum(starts)])
    return np.frombuffer(flat.tobytes().decode().encode("utf-32-le"), np.uint32), before[offsets]


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many are set in each row's stretch."""
    out = np.zeros(len(offsets) - 1, np.int32)
    some = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(some):
        out[some] = np.add.reduceat(values.view(np.uint8), offsets[some], dtype=np.int32)
    return out


def packed(bits: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """Each row's bits as 64-bit words, bit i of a row in word i // 64 at place i % 64."""
    lengths = np.diff(offsets)
    words = (lengths + 63) // 64
    starts = np.concatenate([[0], np.cumsum(words)])
    padded = np.zeros(int(starts[-1]) * 64, bool)
    padded[np.arange(len(bits)) + np.repeat(starts[:-1] * 64 - offsets[:-1], lengths)] = bits
    values = np.packbits(padded, bitorder="little").view("<i8")
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int64()))


def whole_words(equal: np.ndarray, blank: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each blank-separated word of one side is matched throughout, and the rows' offsets into that."""
    if not len(blank):
        return np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    opens = np.concatenate([[True], blank[:-1]])
    opens[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    starts = np.flatnonzero(opens)
    return np.logical_and.reduceat(equal | blank, starts), np.searchsorted(starts, offsets)


def _compared(a: pa.Array, b: pa.Array, newlines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    (left, offsets), (right, _) = points(a), points(b)
    blank1, blank2 = left == 32, right == 32
    equal = left == right
    if newlines:
        blank1, blank2 = blank1 | (left == 10), blank2 | (right == 10)
        equal = equal | (blank1 & blank2)
    return equal, blank1, blank2, offsets


PIECE = 1 << 16


def _counted(a: pa.Array, b: pa.Array, newlines: bool, full: bool) -> pa.Array:
    """In pieces of about 64 KB, which stay in the processor's cache."""
    bytes_ = pc.fill_null(pc.binary_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(bytes_) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(a)]
    parts = [_piece(a.slice(i, j - i), b.slice(i, j - i), newlines, full) for i, j in zip(cuts, cuts[1:])]
    return pa.concat_arrays(parts)


def _piece(a: pa.Array, b: pa.Array, newlines: bool, full: bool) -> pa.StructArray:
    equal, blank1, blank2, offsets = _compared(a, b, newlines)
    words = [whole_words(equal, blank, offsets) for blank in (blank1, blank2)]
    columns = [_per_row(equal & ~blank1, offsets), _per_row(equal, offsets), *[_per_row(m, at) for m, at in words]]
    columns = [pa.array(c, pa.int32()) for c in columns]
    names = ["ch", "ch_all", "w1", "w2"]
    if full:
        columns += [packed(equal, offsets), *[packed(m, at) for m, at in words]]
        names += ["chars", "words1", "words2"]
    return pa.StructArray.from_arrays(columns, names)


def counts(newlines: bool = False):
    """Arrow function `(s1, s2) -> struct`: equal characters without and with blanks, matched words of either side."""

    def count(a: pa.Array, b: pa.Array) -> pa.Array:
        from spolia.functions.arrow_kernel import _counted

        return _counted(a, b, newlines, False)

    return F.arrow_udf(count, COUNTS)


def marks(newlines: bool = False):
    """`counts`, and the matched characters and words as packed bits; with `newlines` a line break is a blank."""

    def mark(a: pa.Array, b: pa.Array) -> pa.Array:
        from spolia.functions.arrow_kernel import _counted

        return _counted(a, b, newlines, True)

    return F.arrow_udf(mark, MARKS)


def compare():
    """Scalar Arrow function `(s1, s2) -> mask`; both strings have the same length or are null."""

    def mask(a: pa.Array, b: pa.Array) -> pa.Array:
        from spolia.functions.arrow_kernel import _compared

        equal, blank1, blank2, offsets = _compared(a, b, False)
        symbols = np.full(equal.shape, ord("0"), dtype=np.uint8)
        symbols[blank1] = ord("p")
        symbols[blank2] = ord("q")
        symbols[equal] = ord("1")
        symbols[equal & blank1] = ord(" ")
        buffers = [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(symbols.tobytes())]
        return pa.Array.from_buffers(pa.large_string(), len(a), buffers).cast(pa.string())

    return F.arrow_udf(mask, "string")
