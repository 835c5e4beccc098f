"""Language-model scoring: causal self-attention over subword ids, mixed with word counts of the whole corpus.

Gathered from all training texts by Spark: the count of every word, and from these the counts of subwords (first in
a word or not, ending a word or not), the neighbours by which subwords are classed, and the table of class pairs.  The
attention weights see these classes, not the subwords.  Training texts are stored as shards of about SHARD_SYMBOLS
subwords, held-out texts as shards of their own, so that each text is encoded once; in each of ROUNDS rounds every shard goes by gradients over all its blocks, in a new order, from the
same weights, and the changes, weighted by blocks, are summed by Spark: the work grows with the corpus.  The same files give
the same shards.  A word's probability is a mixture of the product over its subwords and of its share of the training words;
the attention model's part of all words is computed once and stored.  The weight of the mixture is fitted on the counts of log
ratios of the two over all training texts, with each occurrence left out of its own count.  The FREQUENT most frequent words travel to the tasks (a bounded table); the others meet their counts in a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spolia.llm import attention as A
from spolia.llm.bpe_pieces import read_ranks
from spolia.llm.common import LOWER, UPPER, batch_rows, filled, slices, written

FREQUENT = 200_000
SHARD_SYMBOLS = 1 << 18
SHARDS_A_FILE = 8  # so that the shards spread over tasks
ROUNDS = 2
BINS, FAR = 64, 60  # log ratios are counted in steps of 1 / BINS up to FAR
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def word_list(text: str) -> list[bytes]:
    """Words with A-Z in lower case."""
    return text.encode().translate(_LOWER).split()


@lru_cache(maxsize=1)
def subwords(path: str, pattern: str) -> tiktoken.Encoding:
    ranks = {token: rank for rank, token in enumerate(read_ranks(path))}
    return tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def split_words(words: list[bytes], path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of the words one after the other, and how many each has."""
    encode = subwords(path, pattern).encode_ordinary
    ids = [encode(w.decode()) for w in words]
    flat = np.fromiter((i for x in ids for i in x), np.int32)
    return flat, np.array([len(x) for x in ids], np.int32)


def held_out(key: str = "doc_id") -> Column:
    """Whether a text is not learned from: crc32 of its key as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """`word`, `n` over all rows of `text`, counted within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        from collections import _count_elements

        for piece in slices(batches, "text", 1 << 20):
            for text in piece.column(0).to_pylist():
                _count_elements(held, word_list(text))
            if len(held) > 400_000:
                yield out()
        if held:
            yield out()

    return texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def symbols_of(classes: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, words_before: np.ndarray) -> tuple:
    """Targets (subwords and ends), whether first and last in a word, the symbols before them and starts of texts.

    `words_before`: number of words before each text, and of all.  After the words of each text comes its end.
    """
    end = len(classes) - 1
    texts = len(words_before) - 1
    cuts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    text_ends = cuts[words_before[1:]]  # subwords before the end of each text
    targets = np.insert(tokens, text_ends, end) if texts else tokens
    last = np.zeros(len(tokens), bool)
    last[cuts[1:] - 1] = True
    first = np.zeros(len(tokens), bool)
    first[cuts[:-1]] = True
    last, first = np.insert(last, text_ends, True), np.insert(first, text_ends, True)
    ends = text_ends + np.arange(texts)
    starts = np.concatenate([[0], ends[:-1] + 1]) if texts else ends
    before = np.empty(len(targets), np.int64)
    before[1:] = 2 * classes[targets[:-1]] + last[:-1]
    before[starts] = A.SYMBOLS - 1
    return targets, first, last, before, np.repeat(starts, np.diff(np.concatenate([[0], ends + 1])))


@dataclass
class Model:
    """What a task needs."""

    path: str
    pattern: str
    weights: A.Weights
    classes: np.ndarray  # of the subwords; one more for the end of a text
    within: np.ndarray  # [2, subwords]: log of the share of its class, inside words and first in a word
    stop: np.ndarray  # [2, subwords]: log of going on and of ending the word after a subword
    mixture: float  # weight of the attention model
    n: int  # words (and ends) of the training texts
    v: int  # distinct ones
    ends: int  # training texts
    words: list[bytes]  # frequent ones
    counts: np.ndarray

    def word_logs(self, lengths: np.ndarray, tokens: np.ndarray, words_before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log of the attention model's probability of each word, and of each text's end."""
        targets, first, last, before, starts = symbols_of(self.classes, lengths, tokens, words_before)
        logs = A.class_log_probabilities(self.weights, before, starts, self.classes[targets]).astype(np.float64)
        logs += self.within[first.astype(np.int8), targets]
        logs += self.stop[last.astype(np.int8), targets]
        end = targets == len(self.classes) - 1
        return np.add.reduceat(logs[~end], np.flatnonzero(first[~end])) if len(tokens) else np.zeros(0), logs[end]

    def mixed(self, log_word: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of the mixture of the attention model and the words' shares."""
        with np.errstate(divide="ignore"):
            share = np.log(np.where(count > 0, (count + 1.0) / (self.n + self.v + 1.0), 0.0))
        return np.logaddexp(math.log(self.mixture) + log_word, math.log1p(-self.mixture) + share) / math.log(10)


def subword_counts(counts: DataFrame, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """[2, subwords] counts inside words and first in a word; [2, subwords] counts of going on and of ending a word."""
    size = len(read_ranks(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((4, size), np.int64)
        for batch in batches:
            flat, lengths = split_words(batch.column(0).to_pylist(), path, pattern)
            n = np.repeat(batch.column(1).to_numpy(), lengths)
            cuts = np.cumsum(lengths)
            first, last = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
            first[cuts - lengths], last[cuts - 1] = 1, 1
            np.add.at(table, (first, flat), n)
            np.add.at(table, (2 + last, flat), n)
        rows, ids = np.nonzero(table)
        yield pa.record_batch([pa.array(rows * size + ids), pa.array(table[rows, ids])], ["at", "n"])

    found = counts.select("word", "n").mapInArrow(work, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(4 * size)
    table[found["at"].to_numpy()] = found["n"].to_numpy()
    table = table.reshape(4, size)
    return table[:2], table[2:]


class Encoder:
    """Subword ids of texts; `words` are encoded before (`flat`, `lengths`).  One per task."""

    def __init__(self, words: list[bytes], flat: np.ndarray, lengths: np.ndarray, path: str, pattern: str) -> None:
        self.path, self.pattern, self.index = path, pattern, {w: k for k, w in enumerate(words)}
        self.flat, self.lengths = flat, lengths

    def of(self, texts: list[str]) -> tuple:
        """Number of words of each text; place (from the number of `words` on: others), length and subword ids of each word; the other words."""
        lists = [word_list(t) for t in texts]
        sizes = np.array([len(ws) for ws in lists], np.int64)
        words = [w for ws in lists for w in ws]
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        rare = np.flatnonzero(at < 0)
        rare_words = [words[k] for k in rare.tolist()]
        new = {w: k for k, w in enumerate(dict.fromkeys(rare_words))}
        new_flat, new_lengths = split_words(list(new), self.path, self.pattern)
        at[rare] = np.fromiter(map(new.__getitem__, rare_words), np.int64, len(rare)) + len(self.index)
        return sizes, at, *spelt(at, np.concatenate([self.flat, new_flat]), np.concatenate([self.lengths, new_lengths])), rare_words


def spelt(at: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and subword ids of the words at places of a list, whose words have `lengths` ids each in `flat`."""
    firsts = np.cumsum(lengths, dtype=np.int64) - lengths
    mine = lengths[at]
    skip = np.repeat(firsts[at] - (np.cumsum(mine, dtype=np.int64) - mine), mine)
    return mine, flat[skip + np.arange(len(skip))]


SHARD = "learned boolean, keys array<bigint>, sizes binary, at binary, others array<binary>, tokens binary, lengths binary"


def encoded(documents: DataFrame, known: tuple[list[bytes], np.ndarray, np.ndarray], path: str, pattern: str, whole: bool = False) -> DataFrame:
    """All of `text` as shards, many texts in a row: whether they are `learned` from, `keys` of the texts, `sizes` (words) of texts, the place
    of each word among `known` (words, subword ids, lengths) or after them (`at`), the `others`, and the subword ids (`tokens`) and `lengths`
    of the others, or of all words (`whole`).  Numbers stand as bytes."""
    shared = documents.sparkSession.sparkContext.broadcast(known)
    names = [c.split()[0] for c in SHARD.split(", ")]

    def shard(learned: bool, held: list[tuple]) -> pa.RecordBatch:
        keys, sizes, at, others, tokens, lengths = zip(*held, strict=True)
        cells = [learned, [k for x in keys for k in x], np.concatenate(sizes).tobytes(), np.concatenate(at).tobytes(),
                 [w for x in others for w in x], np.concatenate(tokens).tobytes(), np.concatenate(lengths).tobytes()]
        types = [pa.bool_(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array([c], t) for c, t in zip(cells, types, strict=True)], names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, n = Encoder(*shared.value, path, pattern), {True: [], False: []}, {True: 0, False: 0}
        most = len(encoder.index)
        for batch in batches:
            for learned in held:
                mine = batch.filter(batch.column(2) if learned else pc.invert(batch.column(2)))
                for piece in slices(iter([mine]), "text", 1 << 20):
                    sizes, at, lengths, tokens, others = encoder.of(piece.column(1).to_pylist())
                    n[learned] += len(tokens) + len(sizes)
                    if not whole:
                        tokens, lengths = tokens[np.repeat(at >= most, lengths)], lengths[at >= most]
                    held[learned].append((piece.column(0).to_pylist(), sizes, np.minimum(at, most).astype(np.int32), others, tokens, lengths))
                    if n[learned] >= SHARD_SYMBOLS:
                        yield shard(learned, held[learned])
                        held[learned], n[learned] = [], 0
        for learned, rest in held.items():
            if rest:
                yield shard(learned, rest)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled().alias("text"), (~held_out()).alias("learned")).mapInArrow(each, SHARD)


def shards_of(learned: DataFrame, known: list[bytes], path: str, pattern: str) -> DataFrame:
    """All of `text` as shards to learn from, whole: `tokens`, `lengths`, `sizes`."""
    texts = learned.select(F.lit(None).alias("doc_id"), "text")
    return encoded(texts, (known, *split_words(known, path, pattern)), path, pattern, whole=True).select("tokens", "lengths", "sizes")


def shard_arrays(batch: pa.RecordBatch, known: Broadcast | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lengths and tokens of all words of each shard, and words before each text; `known`: the words that shards of `encoded` leave out."""
    for k in range(batch.num_rows):
        tokens, lengths, sizes = (np.frombuffer(batch.column(c)[k].as_py(), t) for c, t in (("tokens", np.int32), ("lengths", np.int32), ("sizes", np.int64)))
        if known is not None:
            words, flat, each = known.value
            at = np.frombuffer(batch.column("at")[k].as_py(), np.int32).astype(np.int64)
            at[at == len(words)] += np.arange(len(lengths))
            lengths, tokens = spelt(at, np.concatenate([flat, tokens]), np.concatenate([each, lengths]))
        yield lengths, tokens, np.concatenate([[0], np.cumsum(sizes)])


def summed_places(shards: DataFrame, size: int, work: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], known: Broadcast | None = None) -> np.ndarray:
    """`size` numbers: how often `work` names each place over all shards; tasks send the places that occur, with counts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths, tokens, before in shard_arrays(batch, known):
                at, n = np.unique(work(lengths, tokens, before), return_counts=True)
                for k in range(0, len(at), 1 << 16):
                    yield pa.record_batch([pa.array(at[k : k + (1 << 16)]), pa.array(n[k : k + (1 << 16)])], ["at", "n"])

    with batch_rows(shards.sparkSession, 1):
        found = shards.mapInArrow(each, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.float32)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


def summed(shards: DataFrame, size: int, work: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], None], known: Broadcast | None = None) -> np.ndarray:
    """`size` numbers, to which `work` adds what each shard (its lengths, tokens and words before each text) gives."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for lengths, tokens, before in shard_arrays(batch, known):
                work(total, lengths, tokens, before)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 1 << 18):
            yield pa.record_batch([pa.array(at[k : k + (1 << 18)]), pa.array(total[at[k : k + (1 << 18)]])], ["at", "n"])

    with batch_rows(shards.sparkSession, 1):
        found = shards.mapInArrow(each, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


def class_neighbours(shards: DataFrame, totals: np.ndarray, known: Broadcast | None = None) -> np.ndarray:
    """[subwords, 2 * FEATURES]: how often each frequent subword stands before and after each subword."""
    column = A.frequent_of(totals)

    def places(lengths: np.ndarray, tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
        return A.neighbours_of(symbols_of(np.zeros(len(column), np.int64), lengths, tokens, before)[0], column)

    return summed_places(shards, len(totals) * 2 * A.FEATURES, places, known).reshape(len(totals), 2 * A.FEATURES)


def trained(shards: DataFrame, classes: np.ndarray, known: Broadcast | None = None) -> A.Weights:
    """Attention weights of all shards."""

    def pairs(total: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, before: np.ndarray) -> None:
        targets, _, _, symbols, _ = symbols_of(classes, lengths, tokens, before)
        total += np.bincount(symbols * A.CLASSES + classes[targets], minlength=len(total))

    weights = A.first_weights(summed(shards, A.SYMBOLS * A.CLASSES, pairs, known).reshape(A.SYMBOLS, A.CLASSES))
    for turn in range(ROUNDS):
        flat = np.concatenate([p.ravel() for p in weights.parts()])
        now = shards.sparkSession.sparkContext.broadcast(weights)

        def change(total: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, before: np.ndarray, turn: int = turn, now=now) -> None:
            targets, _, _, symbols, starts = symbols_of(classes, lengths, tokens, before)
            new, blocks = A.train(now.value, symbols, starts, classes[targets], 0.01 * 0.5**turn, seed=11 + turn)
            total[:-1] += blocks * np.concatenate([(p - q).ravel() for p, q in zip(new.parts(), now.value.parts(), strict=True)]).astype(np.float64)
            total[-1] += blocks

        sums = summed(shards, len(flat) + 1, change, known)
        flat = (flat + sums[:-1] / max(sums[-1], 1.0)).astype(np.float32)
        cuts = np.cumsum([p.size for p in weights.parts()])[:-1]
        weights = A.Weights(*[f.reshape(p.shape) for f, p in zip(np.split(flat, cuts), weights.parts(), strict=True)])
    return weights


ATTENDED = "learned boolean, keys array<bigint>, sizes binary, at binary, others array<binary>, logs binary, ends binary"


def attended(shards: DataFrame, model: Model, known: Broadcast) -> DataFrame:
    """The attention model's natural log probability of each word (`logs`) and end (`ends`) of all shards of `encoded`."""
    shared = shards.sparkSession.sparkContext.broadcast(replace(model, words=[], counts=np.zeros(0)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, ends = [], []
            for lengths, tokens, before in shard_arrays(batch, known):
                log, end = shared.value.word_logs(lengths, tokens, before)
                logs.append(log.astype(np.float32).tobytes())
                ends.append(end.astype(np.float32).tobytes())
            kept = [batch.column(c) for c in ("learned", "keys", "sizes", "at", "others")]
            yield pa.record_batch([*kept, pa.array(logs, pa.binary()), pa.array(ends, pa.binary())], [c.split()[0] for c in ATTENDED.split(", ")])

    with batch_rows(shards.sparkSession, 1):
        return written(shards.mapInArrow(each, ATTENDED), "attended", SHARDS_A_FILE, "zstd")


def attended_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Keys and sizes of texts, places of words, the other words, logs of words and of ends of each row of `attended`."""
    for batch in batches:
        for k in range(batch.num_rows):
            cell = {c: batch.column(c)[k] for c in batch.schema.names}
            arrays = [np.frombuffer(cell[c].as_py(), t) for c, t in (("sizes", np.int64), ("at", np.int32), ("logs", np.float32), ("ends", np.float32))]
            yield cell["keys"].values, arrays[0], arrays[1], cell["others"].values, arrays[2].astype(np.float64), arrays[3].astype(np.float64)


def mixture_of(parts: DataFrame, counts: DataFrame, model: Model) -> float:
    """Weight of the attention model that fits words and ends best, each left out of its own count.

    Over all training texts (`parts`: of `attended`); 0.5 where there are none.
    """
    known, own_counts, ends = len(model.words), parts.sparkSession.sparkContext.broadcast(model.counts), float(model.ends)
    total, top = model.n + model.v + 1, BINS * FAR

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(2 * top + 1, np.int64)
        for _, _, at, others, logs, end_logs in attended_rows(batches):
            frequent = at < known
            own = np.concatenate([own_counts.value[at[frequent]], np.full(len(end_logs), ends)])
            ratio = np.concatenate([logs[frequent], end_logs]) - np.log(own / total)
            place = np.where(own > 1, np.floor(ratio * BINS).clip(-top, top), top).astype(np.int64)
            seen += np.bincount(place + top, minlength=len(seen))
            if n := len(others):
                yield pa.record_batch([others, pa.array(logs[~frequent]), pa.nulls(n, pa.int64()), pa.array(np.ones(n, np.int64))], names)
        places = np.flatnonzero(seen)
        # No word has a space in it, so these rows match none.
        yield pa.record_batch([pa.array([b" %d" % k for k in places.tolist()], pa.binary()), pa.nulls(len(places), pa.float64()), pa.array(places - top), pa.array(seen[places])], names)

    names = ["word", "log", "place", "times"]
    rows = parts.where("learned").mapInArrow(each, "word binary, log double, place bigint, times bigint").join(counts, "word", "left")
    ratio = F.floor((F.col("log") - F.log(F.col("n") / float(total))) * BINS).cast("bigint")
    place = F.when(F.col("n") > 1, F.greatest(F.lit(-top), F.least(F.lit(top), ratio))).otherwise(top)
    with batch_rows(parts.sparkSession, 1):
        found = rows.groupBy(F.coalesce("place", place).alias("place")).agg(F.sum("times").alias("times")).orderBy("place").toArrow()
    times, odds = found["times"].to_numpy(), np.exp((found["place"].to_numpy() + 0.5) / BINS)
    odds[found["place"].to_numpy() == top] = np.inf
    mixture = 0.5
    for _ in range(20 if times.sum() else 0):
        part = 1 / (1 + (1 - mixture) / (mixture * odds))
        mixture = float(np.clip((part * times).sum() / times.sum(), 0.01, 0.99))
    return mixture


def fit(documents: DataFrame, counts: DataFrame, path: str, pattern: str) -> Model:
    """The model of the training rows of `documents` and their word counts (`word`, `n`, without ends)."""
    return learn(documents, counts, path, pattern)[0]


def learn(documents: DataFrame, counts: DataFrame, path: str, pattern: str) -> tuple[Model, DataFrame]:
    """`fit`, and what its attention model gives for the words of all rows (`attended`)."""
    ends = documents.where(~held_out()).count()
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = words + ends, distinct + (ends > 0)
    steps = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toArrow()  # as many rows as distinct counts
    running = np.cumsum(steps["words"].to_numpy())
    kept = int((running <= FREQUENT).sum())
    least = int(steps["n"][kept - 1].as_py()) if kept else None
    frequent = counts.where(F.col("n") >= least).toArrow().sort_by("word") if kept else counts.limit(0).toArrow()
    known, known_counts = frequent["word"].to_pylist(), frequent["n"].to_numpy().astype(np.float64)

    inside, stops = subword_counts(counts, path, pattern)
    spelling = (known, *split_words(known, path, pattern))
    everything = written(encoded(documents, spelling, path, pattern), "shards", SHARDS_A_FILE, "zstd")
    shards, shared = everything.where("learned").select("sizes", "at", "tokens", "lengths"), documents.sparkSession.sparkContext.broadcast(spelling)
    totals = np.append(inside.sum(axis=0), ends)
    classes = A.classes_of(totals, class_neighbours(shards, totals, shared))
    within = np.zeros((2, len(totals)))
    for k in (0, 1):
        each = np.append(inside[k] + 0.1, 1.0)
        within[k] = np.log(each / np.bincount(classes, weights=each, minlength=A.CLASSES)[classes])
    goes_on = np.log((stops + 0.05) / (stops.sum(axis=0) + 0.1))
    stop = np.hstack([goes_on, np.zeros((2, 1))])
    model = Model(path, pattern, trained(shards, classes, shared), classes, within, stop, 0.5, n, v, ends, known, known_counts)
    parts = attended(everything, model, shared)
    model.mixture = mixture_of(parts, counts, model)
    return model, parts


PARTIAL = "uid bigint, doc_id bigint, word binary, log double, n_tokens bigint, n_known bigint, base double, score double"


def partial_scores(parts: DataFrame, model: Model) -> DataFrame:
    """A row per text with what its frequent words and its end add up to, and a row per occurrence of another word."""
    known, shared = len(model.words), parts.sparkSession.sparkContext.broadcast(replace(model, words=[]))
    names = [c.split()[0] for c in PARTIAL.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        total, uid = m.n + m.v + 1, TaskContext.get().partitionId() << 33
        end_base, end_known = math.log10((m.ends + 1) / total), int(m.ends > 0)
        for keys, sizes, at, others, logs, end_logs in attended_rows(batches):
            rare = np.flatnonzero(at >= known)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            count = np.zeros(len(at))
            frequent = at < known
            count[frequent] = m.counts[at[frequent]]
            sums = [np.bincount(owner[frequent], weights=x[frequent], minlength=len(sizes))
                    for x in (np.ones(len(at)), np.log10((count + 1) / total), m.mixed(logs, count))]
            uids = uid + np.arange(len(sizes))
            uid += len(sizes)
            # No word has a space in it, so these rows match none; they differ so that they spread.
            marks = [b" %d" % u for u in uids.tolist()]
            per_text = [uids, keys, marks, np.zeros(len(sizes)), sizes + 1, sums[0].astype(np.int64) + end_known, sums[1] + end_base,
                        sums[2] + m.mixed(end_logs, np.full(len(sizes), float(m.ends)))]
            yield pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(per_text, types, strict=True)], names)
            if len(rare):
                nothing = [pa.nulls(len(rare), t) for t in types[4:]]
                yield pa.record_batch([pa.array(uids[owner[rare]]), pa.nulls(len(rare), pa.int64()), others, pa.array(logs[rare]), *nothing], names)

    return parts.mapInArrow(each, PARTIAL)


def score(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: `held_out`, `n_tokens` (words and the end), `n_known`, `train_tokens`, `base_score`, `score` (log10).

    Null counts as empty, which is only an end; a null key is learned from; repeated rows are scored each; without
    training rows every word is unknown; an empty table gives an empty result.
    """
    learned = documents.where(~held_out()).select(filled().alias("text"))
    counts = written(word_counts(learned), "words")
    model, parts = learn(documents, counts, path, pattern)
    rows = partial_scores(parts, model).join(counts, "word", "left")
    total = float(model.n + model.v + 1)
    c = F.coalesce(F.col("n"), F.lit(0))
    is_word = F.col("n_tokens").isNull()
    attended = F.col("log") + math.log(model.mixture)
    share = F.log((c + 1) / total) + math.log1p(-model.mixture)
    both = F.greatest(attended, share) + F.log1p(F.exp(-F.abs(attended - share)))
    mixed = F.when(F.col("n") > 0, both).otherwise(attended) / math.log(10)
    sums = rows.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(is_word, (c > 0).cast("bigint")).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.when(is_word, F.log10((c + 1) / total)).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(is_word, mixed).otherwise(F.col("score"))).alias("score"),
    )
    return sums.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"), "base_score", "score")
