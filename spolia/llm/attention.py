"""A small causal self-attention model over subword ids, in numpy.

A symbol is the class of a subword and whether it ended a word.  One attention head over the last symbols of the same
text and a table of the last symbol give the next class; within its class a subword has the share of its
counts, apart for the first subwords of words and the others; a count of endings decides whether a word goes on.  So the
probabilities of all words (and the end of the text) after a context sum to at most one.

Scoring runs over the symbols of many texts at once in blocks of STRIDE queries; each block sees its own and the STRIDE
symbols before it, so windows overlap and each symbol is scored once.  A mask keeps to the past and to the same text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

STRIDE = 16
WIDTH = 16
CLASSES = 128
FEATURES = 100  # most frequent neighbours by which subwords are classed
BLOCKS = 64  # blocks that are computed at once
PIECE = 256  # symbols whose logits are computed at once, few enough for a cache


def frequent_of(counts: np.ndarray) -> np.ndarray:
    """Column of each subword among the FEATURES most frequent ones, -1 for the others."""
    out = np.full(len(counts), -1)
    most = np.argsort(-counts, kind="stable")[:FEATURES]
    out[most] = np.arange(len(most))
    return out


def neighbours_of(targets: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Places in [subwords, 2 * FEATURES], one for each frequent neighbour before and after each subword; an end stands before all."""
    stream = np.concatenate([[len(column) - 1], targets]).astype(np.int64)
    out = []
    for side, (own, other) in enumerate(((stream[1:], stream[:-1]), (stream[:-1], stream[1:]))):
        near = column[other]
        known = near >= 0
        out.append(own[known] * (2 * FEATURES) + side * FEATURES + near[known])
    return np.concatenate(out)


def classes_of(counts: np.ndarray, neighbours: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Class of each subword by its neighbours [subwords, 2 * FEATURES] (k-means); unseen ones share the last but one.

    The last class is that of the end of a text, which is the last subword.
    """
    size = len(counts)
    seen = np.flatnonzero(counts > 0)
    out = np.full(size, CLASSES - 2, np.int64)
    if len(seen) > 1:
        x = np.sqrt(neighbours[seen])
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True)) + 1e-9
        by_count = np.argsort(-counts[seen], kind="stable")
        centers = x[by_count[: CLASSES - 2]].copy()
        weight = counts[seen].astype(x.dtype)[:, None]
        for _ in range(rounds):
            label = (x @ centers.T).argmax(axis=1)
            for k in range(len(centers)):
                if (label == k).any():
                    c = (x[label == k] * weight[label == k]).sum(axis=0)
                    centers[k] = c / (np.sqrt(c @ c) + 1e-9)
        out[seen] = label
    out[size - 1] = CLASSES - 1
    return out


@dataclass
class Weights:
    query: np.ndarray  # [symbols, WIDTH]
    key: np.ndarray
    value: np.ndarray
    distance: np.ndarray  # [2 * STRIDE]
    out: np.ndarray  # [WIDTH, CLASSES]
    table: np.ndarray  # [symbols, CLASSES]

    def parts(self) -> list[np.ndarray]:
        return [self.query, self.key, self.value, self.distance, self.out, self.table]


SYMBOLS = 2 * CLASSES + 1  # class and whether it ended a word; the last one starts a text
_AGO = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None, :]
_PAST = _AGO >= 0


def _windows(rows: np.ndarray, blocks: int) -> np.ndarray:
    """[blocks, 2 * STRIDE, ...] overlapping views of rows that have STRIDE more in front."""
    step = rows.strides[0]
    return np.lib.stride_tricks.as_strided(rows, (blocks, 2 * STRIDE, *rows.shape[1:]), (STRIDE * step, step, *rows.strides[1:]), writeable=False)


def _attention(w: Weights, pair: np.ndarray, met: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Attention before it is cut to texts and divided by its sums: exponentials of the scores of pairs [blocks, STRIDE, 2 * STRIDE].

    Symbols meet each other's query and key in a table of all pairs of symbols, whatever the number of positions.
    """
    if met is not None:
        scores = met[0].take(pair)
        scores *= met[1]
        return scores
    scores = (w.query @ w.key.T).ravel().take(pair)
    scores += np.where(_PAST, w.distance[np.abs(_AGO)], -1e9).astype(scores.dtype)
    np.clip(scores, -60, 30, out=scores)
    return np.exp(scores, out=scores)


def _met(w: Weights) -> tuple[np.ndarray, np.ndarray] | None:
    """Exponentials for `_attention` of many blocks: of all pairs of symbols and of distances; none where scores are clipped."""
    scores = w.query @ w.key.T
    if scores.max() + w.distance.max() > 30 or scores.min() + w.distance.min() < -60:
        return None
    return np.exp(scores).ravel(), np.where(_PAST, np.exp(w.distance)[np.abs(_AGO)], 0).astype(scores.dtype)


def _bound(w: Weights) -> float:
    """No logit lies further from 0: means of values reach no further than the values."""
    return float(max(w.table.max(), -w.table.min()) + np.abs(w.value).max(axis=0) @ np.abs(w.out).max(axis=1))


def _means(w: Weights, symbols: np.ndarray, starts: np.ndarray, met: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """What attention makes of the values, for each symbol after the context (see `forward`)."""
    blocks = (len(symbols) - STRIDE) // STRIDE
    scores = _attention(w, symbols[STRIDE:].reshape(blocks, STRIDE, 1) * SYMBOLS + _windows(symbols, blocks)[:, None, :], met)
    first = starts[STRIDE:].reshape(blocks, STRIDE) - np.arange(blocks)[:, None] * STRIDE
    cut = np.flatnonzero(first.max(axis=1) > 0)  # blocks in which a text starts
    if len(cut):
        scores[cut] *= np.arange(2 * STRIDE)[None, None, :] >= first[cut][:, :, None]
    mean = scores @ _windows(w.value.take(symbols, axis=0), blocks)
    mean /= scores @ np.ones((2 * STRIDE, 1), scores.dtype)
    return mean.reshape(-1, WIDTH)


def forward(w: Weights, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class logits after each symbol, and the means of values.  `symbols` and `starts` (position of the first symbol of the same text)
    have STRIDE rows of context in front of a whole number of blocks; positions count from the first context row."""
    mean = _means(w, symbols, starts)
    return mean @ w.out + w.table[symbols[STRIDE:]], mean


def class_log_probabilities(w: Weights, symbols: np.ndarray, starts: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of the probability of the class that follows each symbol, in blocks of bounded memory."""
    n = len(symbols)
    out = np.empty(n, np.float32)
    size = BLOCKS * STRIDE
    met, wide, ones, rows = _met(w), _bound(w) > 80, np.ones(CLASSES, w.table.dtype), np.arange(PIECE)
    for a in range(0, n, size):
        b = min(n, a + size)
        pad = -(b - a) % STRIDE
        front = min(a, STRIDE)
        fill = STRIDE - front
        s = np.concatenate([np.full(fill, SYMBOLS - 1), symbols[a - front : b], np.full(pad, SYMBOLS - 1)])
        at = np.concatenate([np.zeros(fill, np.int64), np.maximum(starts[a - front : b] - a + STRIDE, 0), np.full(pad, 0)])
        at[:fill] = 0
        mean = _means(w, s, at, met)[: b - a]
        for k in range(a, b, PIECE):
            e = min(b, k + PIECE)
            logits = mean[k - a : e - a] @ w.out
            logits += w.table.take(symbols[k:e], axis=0)
            if wide:
                np.clip(logits, -80, 80, out=logits)  # so that their exponentials fit
            chosen = logits[rows[: e - k], targets[k:e]]
            np.exp(logits, out=logits)
            out[k:e] = chosen - np.log(logits @ ones)
    return out


def first_weights(pairs: np.ndarray, seed: int = 11) -> Weights:
    """Weights to start from; the table comes from the counts of pairs [symbols, CLASSES]."""
    rng = np.random.default_rng(seed)
    pairs = pairs + 0.05
    table = np.log(pairs / pairs.sum(axis=1, keepdims=True))
    shape = (SYMBOLS, WIDTH)
    w = Weights(rng.normal(0, 0.3, shape), rng.normal(0, 0.3, shape), rng.normal(0, 0.3, shape), np.zeros(2 * STRIDE), rng.normal(0, 0.1, (WIDTH, CLASSES)), table)
    return Weights(*[p.astype(np.float32) for p in w.parts()])


def train(w: Weights, symbols: np.ndarray, starts: np.ndarray, targets: np.ndarray, rate: float = 0.01, batch: int = 64, seed: int = 11) -> tuple[Weights, int]:
    """New weights after Adam has gone once over all blocks in random order, and the number of these blocks."""
    rng = np.random.default_rng(seed)
    shapes = [p.shape for p in w.parts()]
    flat = np.concatenate([p.ravel() for p in w.parts()])  # the new weights are views of it
    w = Weights(*[f.reshape(s) for f, s in zip(np.split(flat, np.cumsum([math.prod(s) for s in shapes])[:-1]), shapes, strict=True)])
    m, v, part = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    pad = STRIDE + -len(symbols) % STRIDE if len(symbols) else 0  # a block before the first one, and a whole last one
    live = np.concatenate([np.zeros(STRIDE, bool), np.ones(len(symbols), bool), np.zeros(max(pad - STRIDE, 0), bool)])
    symbols = np.concatenate([np.full(STRIDE, SYMBOLS - 1), symbols, np.full(max(pad - STRIDE, 0), SYMBOLS - 1)])
    starts = np.concatenate([np.zeros(STRIDE, np.int64), starts + STRIDE, np.arange(len(starts), len(starts) + max(pad - STRIDE, 0)) + STRIDE])
    targets = np.concatenate([np.zeros(STRIDE, np.int64), targets, np.zeros(max(pad - STRIDE, 0), np.int64)])
    full = len(symbols) // STRIDE - 1
    order = rng.permutation(full) + 1  # each with the block before it
    for step, k in enumerate(range(0, full, batch), 1):
        chosen = order[k : k + batch]
        rows = (chosen[:, None] * STRIDE + np.arange(-STRIDE, STRIDE)).ravel()
        gradients = _gradients(w, symbols[rows], starts[rows] - (np.repeat(chosen, 2 * STRIDE) - 1) * STRIDE, targets[rows], live[rows])
        g = np.concatenate([x.ravel() for x in gradients])
        np.subtract(g, m, out=part)
        part *= 0.1
        m += part
        np.multiply(g, g, out=part)
        part -= v
        part *= 0.01
        v += part
        np.divide(v, 1 - 0.99**step, out=part)
        np.sqrt(part, out=part)
        part += 1e-6
        np.divide(m, part, out=part)
        part *= rate / (1 - 0.9**step)
        flat -= part
    return w, full


def _sums(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows at each of `size` places."""
    rows = rows.reshape(at.size, -1)
    width = rows.shape[1]
    out = np.zeros((size, width), rows.dtype)
    _add(out, at.ravel(), rows)
    return out


def _add(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row to that of `out` at its place; numbers one by one are added faster than rows."""
    width = rows.shape[1]
    if width > 1:
        at = ((at * width)[:, None] + np.arange(width)).ravel()
    np.add.at(out.reshape(-1), at, rows.reshape(-1))


def _gradients(w: Weights, symbols: np.ndarray, starts: np.ndarray, targets: np.ndarray, live: np.ndarray | None = None) -> list[np.ndarray]:
    """Of the mean loss over the second halves of separate windows of 2 * STRIDE symbols; those not `live` count for nothing."""
    n = len(symbols) // (2 * STRIDE)
    symbols, targets = symbols.reshape(n, 2 * STRIDE), targets.reshape(n, 2 * STRIDE)[:, STRIDE:].ravel()
    own = symbols[:, STRIDE:]
    pair = own[:, :, None] * SYMBOLS + symbols[:, None, :]
    a = _attention(w, pair)
    first = starts.reshape(n, 2 * STRIDE)[:, STRIDE:]
    cut = np.flatnonzero(first.max(axis=1) > 0)
    if len(cut):
        a[cut] *= np.arange(2 * STRIDE)[None, None, :] >= first[cut][:, :, None]
    a /= a @ np.ones((2 * STRIDE, 1), a.dtype)
    value = w.value.take(symbols, axis=0)
    mean = a @ value
    weight = np.full(len(targets), 1 / len(targets), a.dtype)
    if live is not None:
        weight *= live.reshape(n, 2 * STRIDE)[:, STRIDE:].ravel()
    d_mean, out, table = _output_gradients(w, mean.reshape(-1, WIDTH), own.ravel(), targets, weight)
    d_mean = d_mean.reshape(mean.shape)
    d_scores = d_mean @ value.transpose(0, 2, 1)
    d_scores -= np.einsum("ijk,ijk->ij", a, d_scores)[:, :, None]  # nothing is left where a symbol sees only itself
    d_scores *= a
    d_pair = _sums(pair, d_scores, SYMBOLS * SYMBOLS).reshape(SYMBOLS, SYMBOLS)
    d_value = _sums(symbols, a.transpose(0, 2, 1) @ d_mean, SYMBOLS)
    distance = np.zeros_like(w.distance)
    np.add.at(distance, np.abs(_AGO)[_PAST], d_scores.sum(axis=0)[_PAST])
    return [d_pair @ w.key, d_pair.T @ w.query, d_value, distance, out, table]


def _output_gradients(w: Weights, flat: np.ndarray, own: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the weighted loss by the means `flat`, by `out` and by `table`, in pieces that stay in a cache."""
    d_flat, out, table = np.empty_like(flat), np.zeros_like(w.out), np.zeros_like(w.table)
    wide, ones, turned, rows = _bound(w) > 60, np.ones(CLASSES, flat.dtype), np.ascontiguousarray(w.out.T), np.arange(PIECE)
    for k in range(0, len(flat), PIECE):
        x, at = flat[k : k + PIECE], own[k : k + PIECE]
        p = x @ w.out
        p += w.table.take(at, axis=0)
        if wide:
            p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        total = p @ ones
        p[rows[: len(x)], targets[k : k + PIECE]] -= total
        p *= (weight[k : k + PIECE] / total)[:, None]
        np.matmul(p, turned, out=d_flat[k : k + PIECE])
        out += x.T @ p
        _add(table, at, p)
    return d_flat, out, table
