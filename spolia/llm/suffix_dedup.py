"""Removal of every byte that a repeated string of WINDOW bytes covers, by suffix sorting of what can repeat.

Anchors.  Each window of WINDOW bytes has an anchor: the least hash of its GRAM-byte strings, the leftmost on ties.  It
depends on the window alone, so equal windows have equal anchors at equal places.  Windows with the same anchor in a
row form a context (their bytes together).  Only contexts whose anchor occurs again can hold a repeated window.
Suffix order.  Equal contexts are kept once with their number; where all contexts of an anchor occur again, all is said.  The contexts of an anchor meet in one task, are cut
into tokens, and the suffixes at token starts are sorted by grouping (`suffix_groups`).  Windows with the same
distance to the next token start are equal just where the order runs on with enough common bytes from there and the
bytes before agree.
Anchors with more than MOST_CONTEXTS different contexts (a frequent line among changing neighbours) do not fit one
task; their windows are counted by hash instead, spread over all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import batch_rows, filled, flat_bytes, slices, written
from spolia.llm.shingles import _BYTE, mix, powers
from spolia.llm.suffix_groups import suffix_order

WINDOW, GRAM = 200, 40
MOST_CONTEXTS = 6000
TEXT_ROWS = 500  # rows of an Arrow batch
BATCH_BYTES = 1 << 18  # contexts of whole anchors are sorted together up to about this size
FILTER_WORDS = 1 << 18  # 64-bit words of the filters of fixed size
_U = np.uint64
_PLACE = _U((1 << 28) - 1)
_TOKEN = re.compile(rb"[^\x00-\x40]*[\x00-\x40]|[^\x00-\x40]+")


def hashes(flat: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any stretch follows."""
    sums = np.zeros(len(flat) + 1, _U)
    np.cumsum(_BYTE[flat] * powers(len(flat) + 1)[0][: len(flat)], out=sums[1:])
    return sums


def stretch(sums: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    return mix((sums[start + size] - sums[start]) * powers(len(sums))[1][start])


def contexts(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts that lie one after the other: anchor hash, context hash, text, start and number of windows of each context."""
    sums = hashes(flat)
    n = len(flat) - WINDOW + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64, np.int64))
    grams = stretch(sums, np.arange(len(flat) - GRAM + 1), GRAM)
    least = grams & ~_PLACE | np.arange(len(grams), dtype=_U)
    width, have = WINDOW - GRAM + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[: n], least[width - have : width - have + n])
    anchor = (least & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    valid = np.arange(n) + WINDOW <= offsets[1:][text]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(new & valid)
    ends = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    counts = ends - starts + 1
    whole = stretch(sums, starts, counts + WINDOW - 1) ^ mix((anchor[starts] - starts).astype(_U) + _U(1 << 32))
    return grams[anchor[starts]], whole, text[starts], starts - offsets[:-1][text[starts]], counts


def _common(flat: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common bytes from positions a and b on, up to WINDOW; `flat` must go on for so many bytes."""
    words = np.lib.stride_tricks.as_strided(flat.view(np.uint8), (len(flat) - 7, 8), (1, 1))
    out = np.zeros(len(a), np.int64)
    left = np.arange(len(a))
    for k in range(0, WINDOW, 8):
        x, y = words[a[left] + k].view("<u8").ravel(), words[b[left] + k].view("<u8").ravel()
        same = x == y
        differ = x[~same] ^ y[~same]
        lowest = differ & (~differ + _U(1))
        out[left[~same]] = k + np.log2(lowest.astype(np.float64)).astype(np.int64) // 8
        out[left[same]] = k + 8
        left = left[same]
        if not len(left):
            break
    return np.minimum(out, WINDOW)


def repeated(parts: list[bytes], counts: np.ndarray, times: np.ndarray) -> list[np.ndarray]:
    """For each context (its bytes, its number of windows, how often it occurs) which windows occur more than once in all."""
    lengths = np.array([len(p) for p in parts], np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # a byte apart
    joined = b"\0".join(parts) + b"\0" * (WINDOW + 16)
    flat = np.frombuffer(joined, np.uint8)
    lists = [_TOKEN.findall(p) for p in parts]
    rank = {t: k + 2 for k, t in enumerate(sorted(set().union(*lists)))}
    symbols: list[int] = []
    for tokens in lists:
        symbols += map(rank.__getitem__, tokens)
        symbols.append(1)
    symbols.append(0)
    sizes = np.fromiter((len(t) for ts in lists for t in (*ts, b"\0")), np.int64, len(symbols) - 1)
    at = np.cumsum(sizes) - sizes  # where each token, or the end of a context, is
    owner = np.repeat(np.arange(len(parts)), [len(ts) + 1 for ts in lists])
    order = np.array(suffix_order(symbols)[1:], np.int64)
    place = at[order]
    common = np.concatenate([[0], _common(flat, place[:-1], place[1:])]) if len(place) else np.zeros(0, np.int64)
    before = np.concatenate([[0], sizes[:-1]])  # length of the token before
    before[np.concatenate([[True], owner[1:] != owner[:-1]])] = 0
    before = before[order]
    of, first = owner[order], begin[owner[order]]
    last_start = first + counts[of]
    sums = hashes(flat)

    keys, starts = [], []
    # Each window goes by the next token start after its own; the byte before it, which is not its own, plays no part.
    for back in range(1, int(before.max(initial=0)) + 1):
        here = np.flatnonzero((before >= back) & (place - back >= first) & (place - back < last_start))
        if not len(here):
            continue
        start = place[here] - back
        if back < WINDOW:
            run = np.cumsum(common < WINDOW - back)[here]
            key = mix(run.astype(_U) * _U(512) + _U(back)) ^ stretch(sums, start, back)
        else:
            key = stretch(sums, start, WINDOW)
        keys.append(key)
        starts.append(start)
    out = [np.zeros(c, bool) for c in counts]
    if not keys:
        return out
    key, start = np.concatenate(keys), np.concatenate(starts)
    of = np.searchsorted(begin, start, side="right") - 1
    _, inverse = np.unique(key, return_inverse=True)
    again = np.bincount(inverse, weights=times[of])[inverse] > 1
    flags = np.zeros(int(counts.sum()), bool)
    base = np.concatenate([[0], np.cumsum(counts)])
    flags[base[of] + start - begin[of]] = again
    return np.split(flags, base[1:-1])


def runs_of(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    starts = np.flatnonzero(edge == 1)
    return starts.tolist(), (np.flatnonzero(edge == -1) - starts).tolist()


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.int64).view(_U))
    return (h % _U(FILTER_WORDS)).astype(np.int64), _U(1) << ((h >> _U(32)) & _U(63))


def likely(rows: DataFrame, column: str, keys: DataFrame, inverted: bool = False) -> DataFrame:
    """The rows whose `column` is in `keys`, and some others: a filter of fixed size.  `inverted`: all rows but these."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, bit = _bits(batch.column(0).to_numpy())
            yield pa.record_batch([pa.array(where), pa.array(bit.view(np.int64))], ["w", "b"])

    words = keys.mapInArrow(bits, "w bigint, b bigint").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(FILTER_WORDS, _U)
    table[words["w"].to_numpy()] = words["b"].to_numpy().view(_U)
    shared = rows.sparkSession.sparkContext.broadcast(table)
    at = rows.columns.index(column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, bit = _bits(batch.column(at).to_numpy())
            yield batch.filter(pa.array((shared.value[where] & bit != 0) ^ inverted))

    return rows.mapInArrow(keep, rows.schema)


def _contexts_of(texts: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 1 << 19):
            flat, offsets = flat_bytes(piece.column(1))
            anchor, whole, text, start, count = contexts(flat, offsets)
            uid = piece.column(0).to_numpy()[text]
            columns = [anchor.view(np.int64), whole.view(np.int64), uid, start, count]
            yield pa.record_batch([pa.array(c) for c in columns], ["anchor", "whole", "uid", "start", "windows"])

    return texts.mapInArrow(work, "anchor bigint, whole bigint, uid bigint, start bigint, windows bigint")


def _cut_out(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """`anchor`, `whole`, `times`, `windows`, `many`, `bytes` of the contexts in `wanted`."""
    lists = wanted.groupBy("uid").agg(F.collect_list(F.struct("anchor", "whole", "times", "start", "windows", "many")).alias("places"))
    joined = likely(texts, "uid", lists.select("uid")).join(lists, "uid").select("text", "places")
    schema = "anchor bigint, whole bigint, times bigint, windows bigint, many boolean, bytes binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 1 << 20):
            out = []
            for text, places in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                raw = text.encode()
                for p in places:
                    out.append((p["anchor"], p["whole"], p["times"], p["windows"], p["many"], raw[p["start"] : p["start"] + p["windows"] + WINDOW - 1]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return joined.mapInArrow(work, schema)


RANGES = "anchor bigint, whole bigint, first bigint, size bigint"


def _range_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["anchor", "whole", "first", "size"])


def _sorted_ranges(cut: DataFrame) -> DataFrame:
    """Repeated windows of contexts, by suffix order; all contexts of an anchor in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done() -> pa.RecordBatch:
            flags = repeated([h[4] for h in held], np.array([h[3] for h in held]), np.array([h[2] for h in held], np.float64))
            return _range_rows([(h[0], h[1], a, n) for h, f in zip(held, flags, strict=True) for a, n in zip(*runs_of(f), strict=True)])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BATCH_BYTES and row[0] != held[-1][0]:
                    yield done()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield done()

    rows = cut.where("not many").select("anchor", "whole", "times", "windows", "bytes")
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(work, RANGES)


def _counted_ranges(cut: DataFrame) -> DataFrame:
    """Repeated windows of the contexts of anchors that have very many, by counts of hashes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "bytes", 1 << 20):
            flat, offsets = flat_bytes(piece.column(4))
            sums, counts = hashes(flat), piece.column(3).to_numpy()
            owner = np.repeat(np.arange(len(counts)), counts)
            first = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = offsets[:-1][owner] + first
            two = stretch(sums, start, WINDOW // 2) + _U(3) * stretch(sums, start + WINDOW // 2, WINDOW // 2)
            columns = [piece.column(k).to_numpy()[owner] for k in range(3)]
            yield pa.record_batch([pa.array(c) for c in (*columns, first, stretch(sums, start, WINDOW).view(np.int64), two.view(np.int64))],
                                  ["anchor", "whole", "times", "first", "w1", "w2"])

    rows = cut.where("many").select("anchor", "whole", "times", "windows", "bytes")
    each = rows.mapInArrow(windows, "anchor bigint, whole bigint, times bigint, first bigint, w1 bigint, w2 bigint")
    again = each.groupBy("w1", "w2").agg(F.sum("times").alias("all")).where("all > 1")
    return each.join(again, ["w1", "w2"]).select("anchor", "whole", "first", F.lit(1).cast("bigint").alias("size"))


def _covered(texts: DataFrame) -> DataFrame:
    """`uid`, `spans`: places of the repeated windows of each text (`uid`, `text`) that has any."""
    found = written(_contexts_of(texts), "contexts")
    again = written(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    found = written(likely(found, "anchor", again).join(again, "anchor", "left_semi"), "places")
    once = found.groupBy("anchor", "whole").agg(F.count("*").alias("times"), F.min(F.struct("uid", "start", "windows")).alias("p"))
    anchors = once.groupBy("anchor").agg(F.count("*").alias("n"), F.min("times").alias("least"))
    once = written(once.join(anchors, "anchor").select("anchor", "whole", "times", "p.*", (F.col("n") > MOST_CONTEXTS).alias("many"), "least"), "once")
    # Where every context of an anchor occurs again as a whole, all its windows do; nothing is left to compare.
    settled = once.where("least > 1").select("anchor", "whole", F.lit(0).cast("bigint").alias("first"), F.col("windows").alias("size"))
    once = once.where("least = 1")
    cut = written(_cut_out(texts, once), "cut")
    ranges = written(_sorted_ranges(cut).union(_counted_ranges(cut)).union(settled), "ranges")
    covered = found.join(ranges, ["anchor", "whole"]).select("uid", (F.col("start") + F.col("first")).alias("a"), (F.col("size") + WINDOW - 1).alias("n"))
    return written(covered.groupBy("uid").agg(F.collect_list(F.struct("a", "n")).alias("spans")), "covered")


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_bytes`, `n_removed`, `n_spans`, `kept` (the bytes that are left) of every row.

    Null counts as empty.  Rows are numbered once and written with their numbers; all later jobs read these files, so
    it does not matter in which order or parts `df` gives its rows another time.  Repeated rows are repetitions like any others; texts below the window
    stay whole; an empty table gives an empty result.
    """
    rows = df.select(F.col(key).alias("key"), filled(text).alias("text")).withColumn("uid", F.monotonically_increasing_id())
    rows = written(rows, "texts")
    texts = rows.select("uid", "text")
    with batch_rows(df.sparkSession, TEXT_ROWS):
        covered = _covered(texts)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 4 << 20):
            out = []
            for raw, spans in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                raw = raw.encode()
                left, spans_found, kept = 0, 0, []
                for a, b in sorted((s["a"], s["a"] + s["n"]) for s in spans or ()):
                    if a > left or not spans_found:
                        kept.append(raw[left:a])
                        spans_found += 1
                    left = max(left, b)
                kept = b"".join([*kept, raw[left:]])
                out.append((len(raw), len(raw) - len(kept), spans_found, kept))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.record_batch([piece.column(0), *columns], ["key", "n_bytes", "n_removed", "n_spans", "kept"])

    some = likely(rows.select("key", "text", "uid"), "uid", covered.select("uid")).join(covered, "uid", "left").select("key", "text", "spans")
    none = likely(rows.select("key", "text", "uid"), "uid", covered.select("uid"), inverted=True)
    whole, zero = F.encode("text", "UTF-8"), F.lit(0).cast("bigint")
    none = none.select("key", F.octet_length("text").cast("bigint").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), whole.alias("kept"))
    return some.mapInArrow(work, schema).union(none).withColumnRenamed("key", key)


def digest(df: DataFrame) -> DataFrame:
    """Counts and checksum of what is left of each document; written here, so that whole texts go to the workers in small batches."""
    kept = deduplicated(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    with batch_rows(df.sparkSession, TEXT_ROWS):
        return written(kept, "digest")
