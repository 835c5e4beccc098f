"""N-gram Jaccard self-join by a token-group matrix.

Tokens are hashes of word shingles.  Equal sets enter once with their number.  Two sets of a Jaccard
similarity of at least NEAR / 100 differ in a bounded number D of tokens, so of D + 1 parts of the tokens (by hash)
at least one is the same in both; with some more parts at least AGREE are.  The sums of the parts are the columns looked up.  Sets that share a part
are partitioned into groups around the smallest set that they share one with, or around that set's own (HUB_STEPS times).
The sets around one of them make groups of about their square root, so the pairs of these groups are about as many as the sets.  A query
set meets a group only if the groups share AGREE parts and so do the set and the group; of the group those sets are taken that
share as many with the set's.  There the sets first meet as sketches, some bits a token, whose differing bits are no more than the differing tokens;
tokens follow of those sets only that may be similar to another by these, in rounds of a bounded share of all tokens.
A query's overlap with the token union of a group's is counted next, and only groups in which that reaches the least overlap are opened, that is, compared set by set
over the postings of the union.  Long sets and hot parts are aggregated before they are shuffled; no part's or group's
pairs are ever listed as rows, only groups are paired.  Tables go as soon as no later job reads them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import WORD, batch_rows, discard, filled, flat_bytes, map_arrow, slices, written
from spolia.llm.components import components, roots
from spolia.llm.shingles import joined, mix, shingle_hashes

SHINGLE, NEAR = 3, 90
GROUP = 128  # sets that are a group at least; around a hub of n sets GROUP / 2 * sqrt(n)
GROUP_TOKENS = 1 << 20  # tokens of a group, about, unless GROUP sets have more
HUB_STEPS = 2
LINKS = 1 << 20  # pairs of sets that a task holds at once
PIECE = 1 << 18  # bytes of text that are hashed at once
TEXT_ROWS, GROUP_ROWS, SKETCH_ROWS = 500, 2, 16  # rows of an Arrow batch
ROUND_SHARE = 0.25  # of the tokens of all sets: what a round of opened groups moves, about
PASS_SHARE = 0.125  # part rows that are placed at once, as a share of the tokens of all sets
AGREE = 3  # parts that two similar sets have in common at least
FILTER_WORDS = 1 << 18  # 64-bit words of the filter that spares texts without candidates the shuffle; fixed size

_U = np.uint64


@lru_cache(maxsize=4)
def size_classes(near: int) -> np.ndarray:
    """Least size of each class: the sizes that may be similar to a size of one class end within the next one."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, (least[-1] - 1) * 100 // near + 1))
    return np.array(least)


@lru_cache(maxsize=4096)
def part_count(level: int, near: int) -> tuple[int, int]:
    """Number of parts for pairs within a size class and with the one below, and how many more than one are sure to agree.

    Two similar sets differ in at most D tokens, so of D + 1 + m parts m + 1 agree.  Parts without tokens agree by
    accident, so m exceeds the number of empty parts that a set of this class is likely to have by AGREE - 1.
    """
    least = size_classes(near)
    largest, smallest = int(least[level + 1]) - 1, int(least[max(level - 1, 0)])
    most = 2 * largest * (100 - near) // (100 + near)
    if not most:
        return 0, 0  # only equal sets can be similar
    spare = 0
    while True:
        count = most + 1 + spare
        empty = count * np.exp(-smallest / count)
        if spare >= empty + 2 * np.sqrt(empty) - 0.3 + AGREE - 1 or spare > most + AGREE:
            return count, spare
        spare += 1


def parts_of(tokens: np.ndarray, near: int) -> np.ndarray:
    """Sums of the parts of a set: for pairs within its size class and those below, and for pairs with the class above.

    Similar sets have at least AGREE of these sums in common.  Parts without tokens are left out unless there are so many
    that fewer than AGREE of the agreeing ones might have tokens.
    """
    mine = int(np.searchsorted(size_classes(near), len(tokens), side="right")) - 1
    out = []
    for level in (mine, mine + 1):
        count, spare = part_count(level, near)
        if not count:
            continue
        number = (mix(tokens) % _U(count)).astype(np.int64)
        sums = np.zeros(count, _U)
        np.add.at(sums, number, tokens)
        full = np.bincount(number, minlength=count) > 0
        marks = mix(sums + mix(np.arange(count, dtype=_U) + (_U(level) << _U(44))))
        out.append(marks if count - full.sum() > spare + 1 - AGREE else marks[full])
    return np.concatenate(out) if out else np.zeros(0, _U)


def token_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """Distinct shingles of each text (words lower-cased in A-Z), in order."""
    hashes, bounds = shingle_hashes(*joined(texts), shingle, lower=True)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def sets_of(df: DataFrame, key: str, shingle: int) -> DataFrame:
    """`key`, `n`, `s1`, `s2` (two hashes of the set) of every row."""
    rows = df.select(F.col(key).cast("bigint").alias("key"), filled().alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = token_sets([t.encode() for t in batch.column(1).to_pylist()], shingle)
        sums = [[int((mix(s ^ _U(salt)).sum(dtype=_U) + _U(len(s))).astype(np.int64)) for s in sets] for salt in (0x51, 0xA7)]
        columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(x, pa.int64()) for x in sums]]
        return pa.record_batch(columns, ["key", "n", "s1", "s2"])

    return map_arrow(rows, work, "key bigint, n bigint, s1 bigint, s2 bigint", most_bytes=PIECE)


def _filter_bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.int64).view(_U))
    return (h % _U(FILTER_WORDS)).astype(np.int64), _U(1) << ((h >> _U(32)) & _U(63))


def likely(df: DataFrame, key: str, reps: DataFrame, shingle: int, work: Callable, schema: str) -> DataFrame:
    """`work(key, tokens)` of the rows whose key is in `reps` and of some others.

    A filter of FILTER_WORDS words, whatever the number of keys, spares most other texts the work and the shuffle.
    It lets rows through that are not in `reps` (all of them, if it is full), so a join must follow.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, bit = _filter_bits(batch.column(0).to_numpy())
            yield pa.record_batch([pa.array(where), pa.array(bit.view(np.int64))], ["w", "b"])

    words = reps.select("rep").mapInArrow(bits, "w bigint, b bigint").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(FILTER_WORDS, _U)
    table[words["w"].to_numpy()] = words["b"].to_numpy().view(_U)
    shared = df.sparkSession.sparkContext.broadcast(table)
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), filled().alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 4 * PIECE):
            where, bit = _filter_bits(piece.column(0).to_numpy())
            piece = piece.filter(pa.array(shared.value[where] & bit != 0))
            for part in slices(iter([piece]), "text", PIECE):
                yield work(part.column(0), token_sets([t.encode() for t in part.column(1).to_pylist()], shingle))

    return rows.mapInArrow(each, schema)


def part_rows(df: DataFrame, key: str, reps: DataFrame, shingle: int, near: int) -> DataFrame:
    """`part`, `rep`: a row for each part of each set."""

    def work(keys: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        parts = [parts_of(s, near) if len(s) else np.zeros(0, _U) for s in sets]
        owners = np.repeat(keys.to_numpy(), [len(p) for p in parts])
        marks = np.concatenate(parts) >> _U(16)  # enough to tell parts apart, and 48 bits take less of a shuffle
        return pa.record_batch([pa.array(marks.view(np.int64)), pa.array(owners)], ["part", "rep"])

    return likely(df, key, reps, shingle, work, "part bigint, rep bigint")


def candidate_tokens(df: DataFrame, key: str, reps: DataFrame, shingle: int) -> DataFrame:
    """`key`, `tokens` of the rows whose key is in `reps` and of some others."""

    def work(keys: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch([keys, pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "tokens"])

    return likely(df, key, reps, shingle, work, "key bigint, tokens binary")


def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """A hash of the set, then two to four bits a token: which of so many parts of the set have an odd number of tokens.

    A token more or less turns one bit, so two sets of the same number of bits differ in at least as many tokens as bits.
    """
    bits = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    part = (mix(tokens ^ _U(0x3B)) & _U(bits - 1)).astype(np.int64)
    odd = np.packbits((np.bincount(part, minlength=bits) & 1).astype(np.uint8), bitorder="little").view(_U)
    return np.concatenate([mix(tokens ^ _U(0xC5)).sum(dtype=_U)[None], odd])


def folded(odd: np.ndarray, words: int) -> np.ndarray:
    """The same bits for a smaller number of parts (a power of two)."""
    while odd.shape[-1] > words:
        half = odd.shape[-1] // 2
        odd = odd[..., :half] ^ odd[..., half:]
    return odd


def maybe_similar(sizes: np.ndarray, odd: list[np.ndarray], side: np.ndarray, paired: bool, near: int) -> np.ndarray:
    """Marks the sets that may be similar to another one, of the other side if `paired`; those that are not are similar to none."""
    marked = np.zeros(len(sizes), bool)
    words = np.array([len(x) for x in odd])
    stacks = {}
    for of in np.unique(side):
        for w in np.unique(words[side == of]):
            at = np.flatnonzero((side == of) & (words == w))
            at = at[np.argsort(sizes[at], kind="stable")]
            stacks[of, w] = at, sizes[at], {w: np.stack([odd[k] for k in at])}
    for q, size in enumerate(sizes):
        if marked[q]:
            continue
        for (of, w), (at, of_size, bits) in stacks.items():
            if paired and of == side[q]:
                continue
            a, b = np.searchsorted(of_size, [-(-size * near // 100), size * 100 // near + 1])
            if a == b:
                continue
            least = min(w, words[q])
            if least not in bits:
                bits[least] = folded(bits[w], least)
            apart = np.bitwise_count(bits[least][a:b] ^ folded(odd[q], least)).sum(axis=1, dtype=np.int64)
            found = at[a:b][apart * (100 + near) <= (size + of_size[a:b]) * (100 - near)]
            found = found[found != q]
            marked[found] = True
            marked[q] |= len(found) > 0
    return marked


def candidate_sketches(df: DataFrame, key: str, reps: DataFrame, shingle: int) -> DataFrame:
    """`key`, `size`, `sketch` of the rows whose key is in `reps` and of some others."""

    def work(keys: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        sketches = pa.array([sketch_of(s).tobytes() for s in sets], pa.binary())
        return pa.record_batch([keys, pa.array([len(s) for s in sets], pa.int64()), sketches], ["key", "size", "sketch"])

    return likely(df, key, reps, shingle, work, "key bigint, size bigint, sketch binary")


def open_group(queries: list[np.ndarray], group: list[np.ndarray], near: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every query whose overlap with the group's token union is large enough, the members similar to it."""
    flat = np.concatenate(group)
    union, column = np.unique(flat, return_inverse=True)
    member = np.repeat(np.arange(len(group)), [len(g) for g in group])
    order = np.argsort(column, kind="stable")
    postings = member[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(column, minlength=len(union)))])
    sizes = np.array([len(g) for g in group])
    for k, query in enumerate(queries):
        at = np.searchsorted(union, query).clip(max=len(union) - 1)
        at = at[union[at] == query]
        if 100 * len(at) < near * len(query):  # similar sets share at least this much
            continue
        lengths = starts[at + 1] - starts[at]
        first = np.repeat(starts[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        shared = np.bincount(postings[first + np.arange(lengths.sum())], minlength=len(group))
        similar = np.flatnonzero(100 * shared >= near * (len(query) + sizes - shared))
        if len(similar):
            yield k, similar


def linked_sets(df: DataFrame, reps: DataFrame, key: str, shingle: int, near: int, counts: bool = True) -> DataFrame:
    """`rep`, `n` (similar rows with other sets), `low` (a set of the same component) from `rep`, `copies`, `size` (tokens).

    Without `counts` only the components matter (`n` is incomplete): each group first meets one other, and of the
    remaining pairs of groups those are opened whose sets are not all in one component by then.
    """
    parts = part_rows(df, key, reps, shingle, near).repartition("part")
    hubs = parts.groupBy("part").agg(F.min("rep").alias("hub"), F.count("*").alias("sets")).where("sets > 1")
    shared = written(parts.join(hubs.select("part", "hub"), "part"), "parts")
    # A set that shares fewer parts than AGREE with all others together is similar to none.
    member = shared.groupBy("rep").agg(F.min("hub").alias("hub"), F.count("*").alias("parts")).where(F.col("parts") >= AGREE).drop("parts")
    member = written(member, "hubs")
    for _ in range(HUB_STEPS):
        further = member.select(F.col("rep").alias("hub"), F.col("hub").alias("next"))
        member = member.join(further, "hub", "left").select("rep", F.coalesce("next", "hub").alias("hub"))
    member = written(member.join(reps.select("rep", "copies", "size"), "rep"), "around")
    number = member.groupBy("hub").agg(F.count("*").alias("sets"), F.sum("size").alias("tokens"))
    most = F.ceil(F.col("sets") / GROUP)
    least = F.ceil(F.col("sets") / F.greatest(F.lit(float(GROUP)), GROUP / 2 * F.sqrt("sets")))
    splits = F.least(most, F.greatest(least, F.ceil(F.col("tokens") / GROUP_TOKENS)))
    member = member.join(number.select("hub", splits.alias("splits")), "hub")
    member = written(member.select("rep", "copies", F.xxhash64("hub", F.pmod(F.xxhash64("rep"), "splits")).alias("grp")), "members")
    whole = reps.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    passes = max(1, math.ceil(shared.count() / max(1, PASS_SHARE * whole)))

    def placed_in(k: int) -> DataFrame:
        """Parts that several groups have, of one pass; only these make groups meet."""
        rows = shared.where(F.pmod("part", F.lit(passes)) == k).join(member.select("rep", "grp"), "rep")
        rows = rows.select("part", "rep", "grp").repartition("part")
        several = rows.groupBy("part").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo < hi").select("part")
        return written(rows.join(several, "part"), "placed")

    places = [placed_in(k) for k in range(passes)]
    placed = reduce(DataFrame.union, places)
    discard(shared)
    columns = placed.select("part", "grp").distinct()
    meet = columns.join(columns.select("part", F.col("grp").alias("other")), "part").where("grp < other")
    pairs = meet.groupBy("grp", "other").agg(F.count("*").alias("agree")).where(F.col("agree") >= AGREE).select("grp", "other")
    sketches = member.join(candidate_sketches(df, key, member, shingle), F.col("rep") == F.col("key"))
    sketches = written(sketches.select("rep", "copies", "size", "sketch"), "sketches")

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["grp", "other", "side", "rep", "size"]
        for batch in batches:
            for k in range(batch.num_rows):
                sets = batch.column(2)[k].values
                side, rep, size = (sets.field(c).to_numpy() for c in ("side", "rep", "size"))
                flat, at = flat_bytes(sets.field("sketch"))
                odd = [flat[a + 8 : b].copy().view(_U) for a, b in zip(at, at[1:], strict=False)]
                marked = np.flatnonzero(maybe_similar(size, odd, side, batch.column(1)[k].is_valid, near))
                if len(marked):
                    ends = [pa.array([batch.column(c)[k].as_py()] * len(marked), pa.int64()) for c in (0, 1)]
                    yield pa.record_batch([*ends, *[pa.array(x[marked]) for x in (side, rep, size)]], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one, two = ([s for s in batch.column(1)[k].as_py() if s["side"] == side] for side in (0, 1))
                paired = batch.column(0)[k].is_valid
                if paired and not (one and two):
                    continue
                sides = [one, two] if paired else [one]
                ids = np.array([s["rep"] for side in sides for s in side], np.int64)
                copies = np.array([s["copies"] for side in sides for s in side], np.int64)
                sets = [[np.frombuffer(s["tokens"], _U) for s in side] for side in sides]
                n, parent, a, b, held = np.zeros(len(ids), np.int64), np.arange(len(ids)), [], [], 0
                shift = len(one) if paired else 0
                for q, found in open_group(sets[0], sets[-1], near):
                    found = found + shift
                    found = found[found != q]
                    n[q] += copies[found].sum()
                    if shift:
                        n[found] += copies[q]
                    a.append(np.full(len(found), q))
                    b.append(found)
                    held += len(found)
                    if held > LINKS:
                        parent, a, b, held = roots(parent, np.concatenate(a), np.concatenate(b)), [], [], 0
                if a:
                    parent = roots(parent, np.concatenate(a), np.concatenate(b))
                if n.any():
                    low = np.full(len(ids), np.iinfo(np.int64).max)
                    np.minimum.at(low, parent, ids)
                    some = n > 0
                    yield pa.record_batch([pa.array(ids[some]), pa.array(n[some]), pa.array(low[parent][some])], ["rep", "n", "low"])

    def queries(pairs: DataFrame) -> DataFrame:
        """`grp`, `other`, `side`, `rep`: the sets of each pair of groups that share AGREE parts with the group opposite."""
        met = written(meet.join(pairs, ["grp", "other"], "left_semi").select("part", "grp", "other"), "met")
        sides = [met.select("part", F.col(c).alias("own"), "grp", "other", F.lit(k).alias("side")) for k, c in enumerate(("grp", "other"))]
        sets = sides[0].union(sides[1]).join(placed.select("part", "rep", F.col("grp").alias("own")), ["part", "own"])
        return sets.groupBy("grp", "other", "side", "rep").agg(F.count("*").alias("agree")).where(F.col("agree") >= AGREE).drop("agree")

    chosen = queries(pairs)
    several = member.groupBy("grp").count().where("count > 1").select("grp")
    chosen = chosen.union(member.join(several, "grp").select("grp", F.lit(None).cast("bigint"), F.lit(0), "rep"))
    boxes = chosen.join(sketches, "rep").groupBy("grp", "other")
    boxes = boxes.agg(F.collect_set(F.struct("side", "rep", "copies", "size", "sketch")).alias("sets")).select("grp", "other", "sets")
    with batch_rows(df.sparkSession, SKETCH_ROWS):
        kept = boxes.mapInArrow(sieve, "grp bigint, other bigint, side int, rep bigint, size bigint")
        kept = written(kept.groupBy("grp", "other", "side", "rep").agg(F.max("size").alias("size")), "kept")
    discard(*places, sketches)

    def opened(chosen: DataFrame) -> DataFrame:
        chosen = written(chosen, "chosen")
        moved = chosen.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        rounds = max(1, math.ceil(moved / max(1, ROUND_SHARE * whole)))
        linked = []
        for k in range(rounds):
            now = chosen.where(F.pmod(F.xxhash64("grp", "other"), F.lit(rounds)) == k)
            rows = now.join(member.select("rep", "copies"), "rep")
            rows = rows.join(candidate_tokens(df, key, now, shingle), F.col("rep") == F.col("key"))
            boxes = rows.groupBy("grp", "other").agg(F.collect_set(F.struct("side", "rep", "copies", "tokens")).alias("sets")).select("other", "sets")
            with batch_rows(df.sparkSession, GROUP_ROWS):
                linked.append(written(boxes.mapInArrow(work, "rep bigint, n bigint, low bigint"), "linked"))
        return reduce(DataFrame.union, linked)

    if counts:
        return opened(kept)
    pairs = kept.where("other is not null").select("grp", "other").distinct()
    first = written(pairs.groupBy("other").agg(F.min("grp").alias("grp")), "first")
    linked = opened(kept.join(first, ["grp", "other"], "left_semi").union(kept.where("other is null")))
    named = components(linked.select(F.col("rep").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "rep")
    member_of = member.join(named, "rep", "left").select("grp", F.coalesce("component", "rep").alias("component"))
    inside = written(member_of.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi")), "inside")
    rest = pairs.join(first.withColumnRenamed("grp", "done"), "other").where("grp <> done")
    rest = rest.join(inside, "grp").join(inside.select(F.col("grp").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2")), "other")
    rest = rest.where("lo <> hi or lo2 <> hi2 or lo <> lo2").select("grp", "other")
    return linked.union(opened(kept.join(rest, ["grp", "other"], "left_semi")))


def join(df: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, near: int = NEAR, counts: bool = True) -> DataFrame:
    """`key`, `n_shingles`, `n_links` (other rows that link directly; without `counts` some of them), `component_id` of every row.

    Rows with the same set link with each other.  Null or empty texts have an empty set and link with nothing;
    a null key has no component but its own (null) and takes part in none.  Keys are taken to be unique: rows that share
    one share its links (`one_of_each` tells them apart).  A component is named by its smallest key.  An empty table gives an empty result.
    """
    with batch_rows(df.sparkSession, TEXT_ROWS):
        sets = written(sets_of(df, key, shingle), "sets")
    linkable = sets.where("n > 0 and key is not null")
    of_set = linkable.groupBy("s1", "s2").agg(F.min("key").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("size"))
    with batch_rows(df.sparkSession, TEXT_ROWS):
        linked = linked_sets(df, of_set.select("rep", "copies", "size"), key, shingle, near, counts)
    of_set = of_set.join(linked.groupBy("rep").agg(F.sum("n").alias("others")), "rep", "left")
    named = components(linked.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    of_set = of_set.join(named.withColumnRenamed("node", "rep"), "rep", "left")
    links = F.col("copies") - 1 + F.coalesce("others", F.lit(0))
    of_set = of_set.select(F.col("s1").alias("o1"), F.col("s2").alias("o2"), links.alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    rows = sets.select("key", "n", "s1", "s2")
    match = (F.col("s1") == F.col("o1")) & (F.col("s2") == F.col("o2")) & (F.col("n") > 0) & F.col("key").isNotNull()
    return rows.join(of_set, match, "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "key").alias("component_id"))


def one_of_each(df: DataFrame, columns: tuple[str, ...], shingle: int, near: int, key: str = "doc_id") -> DataFrame:
    """One row of each group of near copies (that of the smallest key), and all rows without links.

    Rows that repeat in key and text count once (the least of their other columns stays).  Rows that share a key and
    differ in text are rows of their own: none goes because of another, and of a group the smallest key that only one
    row has stays, or else the row of the least hash.  Rows with a null key or without words all stay.
    """
    kept = list(dict.fromkeys((key, "text", *columns)))
    df = df.select(*kept)
    crowded = written(df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key), "crowded")
    if crowded.isEmpty():
        dropped = join(df, key, shingle, near, counts=False).where(F.col(key) != F.col("component_id")).select(key).distinct()
        return df.join(dropped, key, "left_anti").select(*columns)
    # A range of its own for the rows that no key tells apart.
    own = F.shiftrightunsigned(F.xxhash64(key, "text"), 2) + F.lit(1 << 62)
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    several = df.join(crowded, key, "left_semi")
    rest = F.struct(*[c for c in kept if c not in (key, "text")], F.lit(0).alias("_"))
    once = several.where(~wordless).groupBy(key, "text").agg(F.min(rest).alias("_rest"))
    rows = df.join(crowded, key, "left_anti").withColumn("_id", F.col(key).cast("bigint"))
    rows = rows.unionByName(several.where(wordless).withColumn("_id", F.lit(None).cast("bigint")))
    rows = rows.unionByName(once.select(key, "text", "_rest.*").select(*kept, own.alias("_id")))
    dropped = join(rows, "_id", shingle, near, counts=False).where("_id <> component_id").select("_id").distinct()
    return rows.join(dropped, "_id", "left_anti").select(*columns)
