"""Toxicity by class-conditional Kneser-Ney models of words.

One model of toxic and one of ordinary text give each word's log-likelihood, letter by letter (bytes, up to ORDER
of them, within the word).  Counts of ORDER bytes are discounted per class and interpolated with continuation
counts of shorter ones; the shortest orders are counted over both classes together, so expressions that are rare
in either class fall back to the same probabilities and decide nothing.  The difference of the two
log-likelihoods is normalised by length (of the whole text, by the square root of it, and over the one and the TOP
most telling words, so that a few words in a very long text still count); a logistic regression on rows that the counts have not seen turns that into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import LOWER, UPPER, filled, slices

ORDER = 6
SHARED_ORDERS = 2
DISCOUNT = 2.0
TOP = 4
FEATURES = 4
ROWS_PER_CLASS = 4000  # at most so many labelled rows of each class train the model
CACHED_WORDS = 100_000
START, END = b"\x02", b"\x03"
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def word_list(text: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case."""
    return text.translate(_LOWER).split()


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every word, and the word's end, the ORDER bytes that end there as one number; and where words start."""
    pad = START * (ORDER - 1)
    flat = np.frombuffer(b"".join(pad + w.replace(START, b"").replace(END, b"") + END for w in words), np.uint8).astype(np.uint64)
    ends = np.flatnonzero(flat == END[0])
    keys = np.zeros(len(flat), np.uint64)
    for k in range(ORDER):
        keys[ORDER - 1 :] |= flat[ORDER - 1 - k : len(flat) - k] << np.uint64(8 * k)
    starts = np.concatenate([[0], ends[:-1] + 1])
    scored = np.ones(len(flat), bool)
    for k in range(ORDER - 1):
        scored[starts + k] = False
    return keys[scored], np.concatenate([[0], np.cumsum(ends - starts - (ORDER - 2))])


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << 8 * order) - 1)


def _totals(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct groups in order, and the sums of the rows of `values` (2-d) in each."""
    distinct, inverse = np.unique(groups, return_inverse=True)
    sums = np.stack([np.bincount(inverse, weights=column, minlength=len(distinct)) for column in values.T], axis=1)
    return distinct, sums


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), default)
    at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], default)


@dataclass
class ClassModels:
    """Per order: (n-grams, discounted probabilities), (contexts, weights of the shorter order); columns: toxic, ordinary."""

    levels: list
    known: np.ndarray  # n-grams of full order in either class
    known_ratio: np.ndarray
    weights: np.ndarray  # of the logistic regression

    @classmethod
    def count(cls, words: list[bytes], counts: np.ndarray) -> ClassModels:
        """From words and their counts per class (columns toxic, ordinary)."""
        if not words:
            words, counts = [b""], np.ones((1, 2))
        keys, bounds = windows(words)
        keys, sums = _totals(keys, np.repeat(counts.astype(float), np.diff(bounds), axis=0))
        levels, known = [], keys
        for order in range(ORDER, 0, -1):
            if order < ORDER:  # distinct longer ones that end in it
                keys, sums = _totals(_suffix(keys, order), (sums > 0).astype(float))
            if order == SHARED_ORDERS:
                sums = np.repeat((sums > 0).any(axis=1)[:, None] * sums.sum(axis=1)[:, None], 2, axis=1)
            contexts, of_context = _totals(keys >> np.uint64(8), np.hstack([sums, (sums > 0) * np.minimum(sums, DISCOUNT)]))
            totals = np.maximum(of_context[:, :2], 1e-9)
            own = np.maximum(sums - DISCOUNT, 0) / _look_up(contexts, totals, keys >> np.uint64(8), 1.0)
            back = np.where(of_context[:, :2] > 0, of_context[:, 2:] / totals, 1.0)
            levels.append(((keys, own), (contexts, back)))
        model = cls(levels[::-1], np.zeros(0, np.uint64), np.zeros(0), np.zeros(FEATURES + 1))
        model.known, model.known_ratio = known, model._ratio(known)
        return model

    def _ratio(self, keys: np.ndarray) -> np.ndarray:
        """log P(toxic) - log P(ordinary) of each last byte after the bytes before it."""
        p = np.full((len(keys), 2), 1 / 256)
        for order, ((grams, own), (contexts, back)) in enumerate(self.levels, 1):
            gram = _suffix(keys, order)
            p = _look_up(grams, own, gram, 0.0) + _look_up(contexts, back, gram >> np.uint64(8), 1.0) * p
        p = np.log(p)
        return p[:, 0] - p[:, 1]

    def word_ratios(self, words: list[bytes]) -> np.ndarray:
        keys, bounds = windows(words)
        at = np.searchsorted(self.known, keys).clip(max=len(self.known) - 1)
        ratio = self.known_ratio[at].copy()
        new = self.known[at] != keys
        if new.any():
            distinct, inverse = np.unique(keys[new], return_inverse=True)
            ratio[new] = self._ratio(distinct)[inverse]
        return np.add.reduceat(ratio, bounds[:-1])

    def features(self, ratios: np.ndarray) -> np.ndarray:
        n = len(ratios)
        if not n:
            return np.zeros(FEATURES)
        top = np.sort(np.partition(ratios, n - TOP)[n - TOP :] if n > TOP else ratios)
        total = ratios.sum()
        return np.array([total / n, total / np.sqrt(n), top[-1] / 2, top.sum() / (2 * TOP)])

    def fit(self, features: np.ndarray, labels: np.ndarray, times: np.ndarray, rounds: int = 30) -> None:
        """Ridge logistic regression by Newton steps; each row counts `times`."""
        x = np.hstack([features, np.ones((len(features), 1))])
        ridge = np.diag([1e-2] * FEATURES + [1e-6])
        w = np.zeros(FEATURES + 1)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (times * p * (1 - p))[:, None]) + ridge, x.T @ (times * (p - labels)) + ridge @ w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def probability(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(features @ self.weights[:-1] + self.weights[-1], -30, 30))))


class Scorer:
    """Scores texts with a cache of word ratios; one per task."""

    def __init__(self, model: ClassModels) -> None:
        self.model, self.cache = model, {}

    def features(self, texts: list[bytes]) -> list[np.ndarray]:
        lists = [word_list(t) for t in texts]
        new = list(set().union(*lists).difference(self.cache))
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = list(set().union(*lists))
        for k in range(0, len(new), 50_000):
            part = new[k : k + 50_000]
            self.cache.update(zip(part, self.model.word_ratios(part).tolist(), strict=True))
        get = self.cache.__getitem__
        return [self.model.features(np.fromiter(map(get, ws), np.float64, len(ws))) for ws in lists]


def held_out(key: str = "doc_id") -> Column:
    """Whether a row's label may not be learned: crc32 of its key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> ClassModels:
    """Counts and logistic regression from at most `rows_per_class` labelled rows of each class, whole texts.

    The rows are those of the smallest hashes of doc_id among rows that are not held out; half of them are
    counted, the other half fit the regression, each row of a class for as many as there are of that class for each
    one taken, so the prior is that of all learnable labels.  Rows without label, key or document teach nothing; with one
    class only (or none) every score is that of the prior.
    """
    named = labels.where(F.col("toxic").isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull())
    named = named.select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id").alias("h"))
    learnable = {r["toxic"]: r["n"] for r in named.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = [named.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(rows_per_class) for c in (1, 0)]
    rows = chosen[0].unionByName(chosen[1]).dropDuplicates(["doc_id"])
    rows = documents.select("doc_id", filled().alias("text")).join(F.broadcast(rows), "doc_id")
    rows = rows.select("toxic", (F.pmod("h", F.lit(2)) == 0).alias("counted"), "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Word counts of the counted rows; the other rows as they are."""
        for piece in slices(batches, "text", 1 << 20):
            toxic, counted, texts = (c.to_pylist() for c in piece.columns)
            out: dict[tuple[bytes, int], int] = {}
            for t, c, x in zip(toxic, counted, texts, strict=True):
                for w in word_list(x.encode()) if c else ():
                    out[w, t] = out.get((w, t), 0) + 1
            words = [(w, t, n) for (w, t), n in out.items()]
            yield pa.record_batch([pa.array([w for w, _, _ in words], pa.binary()), pa.array([t for _, t, _ in words], pa.int32()),
                                   pa.array([n for _, _, n in words], pa.int64())], ["word", "toxic", "n"])

    counts = rows.mapInArrow(pack, "word binary, toxic int, n bigint").groupBy("word")
    counts = counts.agg(*[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (1, 0)])
    table = counts.toArrow().sort_by("word")
    sums = np.stack([table["n1"].to_numpy(), table["n0"].to_numpy()], axis=1)
    model = ClassModels.count(table["word"].to_pylist(), sums)

    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = ["toxic", *[f"f{k}" for k in range(FEATURES)]]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Scorer(shared.value)
        for piece in slices(batches, "text", 1 << 20):
            found = of.features([x.encode() for x in piece.column(1).to_pylist()])
            yield pa.record_batch([piece.column(0), *[pa.array([f[k] for f in found], pa.float64()) for k in range(FEATURES)]], names)

    rest = rows.where("not counted").select("toxic", "text")
    table = rest.mapInArrow(measure, "toxic int, " + ", ".join(f"{c} double" for c in names[1:])).toArrow()
    features = np.stack([table[c].to_numpy() for c in names[1:]], axis=1)
    toxic = table["toxic"].to_numpy().astype(float)
    order = np.lexsort([*features.T, toxic])
    if len(set(toxic.tolist())) == 2:
        per_row = [max(1.0, learnable.get(c, 0) / rows_per_class) for c in (0, 1)]
        model.fit(features[order], toxic[order], np.where(toxic[order] == 1, per_row[1], per_row[0]))
    else:
        model.weights[-1] = 2.0 if len(toxic) and toxic.all() else -2.0
    return model


def scores(df: DataFrame, model: ClassModels, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns `keep` and `score` (0 to 1) of every row; null counts as empty, which gets the score of no evidence."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], filled(text).alias("scored"))
    kinds = [f.dataType.simpleString() for f in rows.schema.fields[:-1]]
    names = [f"k{k}" for k in range(len(keep))]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Scorer(shared.value)
        for piece in slices(batches, "scored", 1 << 18):
            found = of.features([x.encode() for x in piece.column(len(keep)).to_pylist()])
            score = pa.array([of.model.probability(f) for f in found], pa.float64())
            yield pa.record_batch([*piece.columns[: len(keep)], score], [*names, "score"])

    schema = ", ".join(f"{n} {k}" for n, k in zip([*names, "score"], [*kinds, "double"], strict=True))
    out = rows.mapInArrow(each, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "score")


def judged(documents: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """Per document: whether its label was held out, its score and whether that reaches `limit`."""
    out = scores(documents, train(documents, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, columns: tuple[str, ...], limit: float = 0.7) -> DataFrame:
    """The documents below `limit`."""
    return scores(documents, train(documents, labels), columns).where(F.col("score") < limit).select(*columns)
