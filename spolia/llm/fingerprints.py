"""Document fingerprints: one-permutation MinHash with optimal densification, kept as packed low-order bits.

Each shingle of SHINGLE words is hashed once; the leading bits choose one of BINS bins and the least hash stays.
An empty bin copies the first non-empty one of its own fixed random order of bins.  Of every bin the BITS lowest
bits, spread by the bin's number, are stored.  The share f of equal bins of two fingerprints is then about J + (1 - J) / 2^BITS, which is solved
for the likeness J.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import filled, slices
from spolia.llm.shingles import joined, mix, shingle_hashes

SHINGLE = 5
BINS, BITS = 512, 4
PROBES = 12  # steps of the fixed orders taken for all texts at once; later ones only where bins are still empty
_NONE = np.iinfo(np.uint64).max


@lru_cache(maxsize=1)
def orders() -> tuple[np.ndarray, np.ndarray]:
    """For each bin its order of the others, and the rank of each bin in it."""
    order = np.argsort(mix(np.arange(7, 7 + BINS * BINS, dtype=np.uint64)).reshape(BINS, BINS), axis=1)
    return order, np.argsort(order, axis=1).astype(np.int16)


def fingerprints(texts: list[bytes]) -> list[bytes]:
    """Packed fingerprints; empty for a text without words."""
    hashes, bounds = shingle_hashes(*joined(texts), SHINGLE)
    counts = np.diff(bounds)
    least = np.full(len(texts) * BINS, _NONE)
    owner = np.repeat(np.arange(len(texts)), counts)
    shift = np.uint64(64 - (BINS - 1).bit_length())
    np.minimum.at(least, owner * BINS + (hashes >> shift).astype(np.int64), hashes)
    least = least.reshape(len(texts), BINS)
    empty = least == _NONE
    empty[counts == 0] = False
    order, rank = orders()
    rows, bins = np.nonzero(empty)
    source = least.copy()
    for k in range(PROBES):
        found = source[rows, order[bins, k]]
        done = found != _NONE
        least[rows[done], bins[done]] = found[done]
        rows, bins = rows[~done], bins[~done]
    for row in np.unique(rows):
        mine = bins[rows == row]
        full = np.flatnonzero(source[row] != _NONE)
        least[row, mine] = source[row, full[rank[np.ix_(mine, full)].argmin(axis=1)]]
    places = mix(np.arange(1, BINS + 1, dtype=np.uint64))  # so that copies of one hash keep different bits in each bin
    low = (mix(least ^ places) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    bits = (low[:, :, None] >> np.arange(BITS, dtype=np.uint8)) & 1
    packed = np.packbits(bits.reshape(len(texts), -1), axis=1, bitorder="little")
    return [p.tobytes() if c else b"" for p, c in zip(packed, counts, strict=True)]


def likeness(one: bytes, two: bytes) -> float:
    """Estimated share of common shingles: 0 to 1.  Two texts without words are alike, one and another are not."""
    if not one or not two:
        return float(one == two)
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
    step = (1 << BITS) - 1
    equal = sum(int(((a ^ b) >> s & step == 0).sum()) for s in range(0, 8, BITS)) / BINS
    chance = 1 / (1 << BITS)
    return max(0.0, (equal - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the following one, as far as that goes."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `text`, `copy`, `bucket`: rows in ranges of the key, each range ending with a copy of the row after it.

    The ranges' bounds are keys that occur, so the first row of a range is known beforehand; the last range ends
    with a copy of the first row of all.  The texts are shuffled once.
    """
    rows = df.select(F.col(key).cast("bigint").alias("key"), filled(text).alias("text")).withColumn("mark", F.xxhash64("text"))
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx("key", shares, 20 * ranges)).first()[0] or []
    bounds = np.unique(np.array(found, np.int64))
    first = rows.select("key", "mark").orderBy(F.col("key").asc_nulls_first(), "mark").limit(1).collect()
    if not first:
        return rows.select("key", "text", F.lit(False).alias("copy"), F.lit(0).alias("bucket"), "mark")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            keys = batch.column(0)
            null = keys.is_null().to_numpy(zero_copy_only=False)
            values = keys.fill_null(0).to_numpy()
            bucket = np.where(null, 0, np.searchsorted(bounds, values, side="right"))
            marks = batch.column(2).to_numpy()
            initial = (null if first[0].key is None else ~null & (values == first[0].key)) & (marks == first[0].mark)
            opening = ~null & (bucket > 0)
            opening[opening] = bounds[bucket[opening] - 1] == values[opening]
            for chosen, of, copy in ((None, bucket, False), (opening, bucket - 1, True), (initial, np.full(len(bucket), len(bounds)), True)):
                part = batch if chosen is None else batch.filter(pa.array(chosen))
                if part.num_rows:
                    where = of if chosen is None else of[chosen]
                    yield pa.record_batch([*part.columns, pa.array(where.astype(np.int32)), pa.array(np.full(part.num_rows, copy))],
                                          ["key", "text", "mark", "bucket", "copy"])

    dealt = rows.mapInArrow(deal, "key bigint, text string, mark bigint, bucket int, copy boolean")
    # A copy of the first row of all comes after every other row of the last range, whatever its key.
    wrap = F.col("copy") & (F.col("bucket") == len(bounds)) & F.col("key").eqNullSafe(F.lit(first[0].key))
    dealt = dealt.withColumn("wrap", wrap).repartition("bucket")
    return dealt.sortWithinPartitions("bucket", "wrap", F.col("key").asc_nulls_first(), "copy", "mark")


def compared(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: length, checksum of the edited text, both fingerprints and the likenesses to the edited and next texts.

    Null counts as empty; the order is that of the key (an integer), nulls first, then of a hash of the text for
    equal keys; a single row is followed by itself; an empty table gives an empty result.
    """
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, whose next one is not known yet
        for piece in slices(batches, "text", 1 << 20):
            keys, texts, copies, buckets = (piece.column(k).to_pylist() for k in range(4))
            prints = fingerprints([t.encode() for t in texts])
            rows = list(zip(keys, texts, copies, buckets, prints, strict=True))
            rows = [held, *rows] if held else rows
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[2] and a[3] == b[3]]
            held = rows[-1]
            changed = [edited(a[1], b[1]).encode() for a, b in pairs]
            out = []
            for (a, b), new, mark in zip(pairs, changed, fingerprints(changed), strict=True):
                out.append((a[0], len(a[1]), hashlib.sha256(new).hexdigest(), a[4].hex(), mark.hex(), likeness(a[4], mark), likeness(a[4], b[4])))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    out = with_following(df, key, text).select("key", "text", "copy", "bucket").mapInArrow(each, schema)
    return out.withColumnRenamed("doc_id", key)
