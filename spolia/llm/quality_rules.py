"""Quality rules on tokeniser fertility.

Each word is cut by a public vocabulary with byte fallback (the word with a space in front, each distinct word of a
batch once).  Three measures describe a text: characters per token, the share of tokens that stand for single bytes,
and the entropy of its tokens in bits.  Bands say what is usual: the corpus's own, one for each language (script
where no language code is given) and length class (power of two of tokens, as the entropy of a text grows
with its length), from medians and quartiles over all documents; and outer bands that hold everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import filled, flat_bytes, slices, written

LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
CACHED_BYTES = 48 << 20
PIECE_BYTES = 1 << 20
LANGUAGE = "^[a-z]{2,3}$"
#: First letters of Unicode names' blocks: upper code points of ranges and the script that ends there (coarse; fixed values).
SCRIPTS = [(0x24F, "latin"), (0x36F, "other"), (0x3FF, "greek"), (0x52F, "cyrillic"), (0x58F, "armenian"), (0x5FF, "hebrew"), (0x77F, "arabic"), (0x8FF, "other"),
           (0xDFF, "indic"), (0xEFF, "thai"), (0x1DFF, "other"), (0x1EFF, "latin"), (0x1FFF, "greek"), (0x2E7F, "other"), (0xD7FF, "cjk"), (0xF8FF, "other"), (0xFAFF, "cjk"), (0x10FFFF, "other")]


@dataclass(frozen=True)
class Bands:
    """Widths of the corpus's bands in robust standard deviations, and the outer bands."""

    fertility: float = 6.0
    entropy: float = 4.5
    fallback: float = 6.0
    least_fertility: float = 0.4
    most_fertility: float = 20.0
    most_fallback: float = 0.5
    least_entropy: float = 2.0


class Pieces:
    """Words as tokens of a vocabulary; one for each Python worker.

    Word k of `ids` has the tokens flat[starts[k]:starts[k + 1]].  When the words take more than `CACHED_BYTES` the
    table is emptied before the next batch.
    """

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.single = np.array([self.model.is_byte(i) for i in range(size)])
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.bytes = 0

    def words(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in the table, which takes in new ones."""
        ids = self.ids
        new = [w for w in dict.fromkeys(words) if w not in ids]
        if new:
            ids.update(zip(new, range(len(ids), len(ids) + len(new)), strict=True))
            tokens = self.model.encode([w.decode() for w in new])
            counts = np.fromiter(map(len, tokens), np.int64, len(new))
            self.flat = np.concatenate([self.flat, np.fromiter((t for x in tokens for t in x), np.int32, int(counts.sum()))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.bytes += sum(map(len, new)) + 100 * len(new)
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def repeated_words(codes: np.ndarray, docs: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each word whether it lies in a window of words that its text holds twice or more.

    `codes` numbers the words, `docs` the texts (ascending).  Windows are numbered exactly: pairs of words, then pairs of
    pairs, up to the window's length.
    """
    n = len(codes)
    covered = np.zeros(n + 1, np.int64)
    if n < window:
        return covered[:n].astype(bool)
    names, length = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while length < window:
        step = min(length, window - length)
        count = len(names) - step
        names = np.unique(names[:count] * (n + 1) + names[step : step + count], return_inverse=True)[1].astype(np.int64)
        length += step
    inside = docs[: n - window + 1] == docs[window - 1 :]
    at = np.flatnonzero(inside)
    keys = docs[at] * (n + 1) + names[at]
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = at[counts[which] > 1]
    covered[starts] += 1
    np.add.at(covered, starts + window, -1)
    return np.cumsum(covered[:n]) > 0


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the stretches between offsets; empty ones give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _members(values: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


def entropies(docs: np.ndarray, tokens: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Bits per token of each text; `docs` and `tokens` run in parallel, `counts` are tokens per text."""
    out = np.zeros(len(counts))
    pairs, n = np.unique(docs * size + tokens, return_counts=True)
    doc = pairs // size
    np.add.at(out, doc, n * np.log2(n))
    some = counts > 0
    out[some] = np.log2(counts[some]) - out[some] / counts[some]
    return np.maximum(out, 0)


def _script(text: str, bounds: np.ndarray, names: list[str]) -> str:
    """The script of most letters; `none` without letters."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "none"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = points[(points > 0x7F) | ((points | 32) - 97 < 26)]
    found = np.bincount(np.searchsorted(bounds, letters), minlength=len(names))
    tally: dict[str, int] = {}
    for name, n in zip(names, found.tolist(), strict=True):
        tally[name] = tally.get(name, 0) + n
    return max(sorted(tally), key=tally.__getitem__) if len(letters) else "none"


FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
          ("n_tokens", pa.int64()), ("n_fallback", pa.int64()), ("entropy", pa.float64()), ("script", pa.string())]


def measured(batch: list[str | None], column: pa.Array, of: Pieces) -> list[pa.Array]:
    """The base counts and the tokeniser's measures of some texts."""
    if of.bytes > CACHED_BYTES:
        of.clear()
    flat, offsets = flat_bytes(column)
    space = _members(SPACES)[flat]
    chars = _sums(((flat & 0xC0) != 0x80) & ~space, offsets)
    symbols = _sums(_members(SYMBOLS)[flat], offsets)
    raw = flat.tobytes()
    lists = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    n_words = np.fromiter(map(len, lists), np.int64, len(lists))
    codes = of.words([w for words in lists for w in words])
    docs = np.repeat(np.arange(len(lists)), n_words)
    ends = np.concatenate([[0], np.cumsum(n_words)])
    repeats = _sums(repeated_words(codes, docs), ends)
    lengths = of.starts[codes + 1] - of.starts[codes]
    at = np.repeat(of.starts[codes] - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(codes) else lengths, lengths) + np.arange(int(lengths.sum()))
    tokens = of.flat[at]
    n_tokens = _sums(lengths, ends)
    token_docs = np.repeat(np.arange(len(lists)), n_tokens)
    fallback = np.bincount(token_docs, weights=of.single[tokens], minlength=len(lists)).astype(np.int64)
    bits = entropies(token_docs, tokens.astype(np.int64), n_tokens, of.size)
    blank = SPACES.decode()
    doubled, scripts = [], []
    bounds, names = np.array([b for b, _ in SCRIPTS]), [s for _, s in SCRIPTS]
    for text in batch:
        lines = [x for x in (text or "").split("\n") if x.strip(blank)]
        doubled.append(len(lines) - len(set(lines)))
        scripts.append(_script(text or "", bounds, names))
    values = [n_words, chars, symbols, doubled, repeats, n_tokens, fallback, bits, scripts]
    return [pa.array(v, kind) for v, (_, kind) in zip(values, FIELDS, strict=True)]


def measures(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """`key`, `lang`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, `n_tokens`, `n_fallback`, `entropy`, `script`."""
    language = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    rows = docs.select(F.col(key).alias("key"), language.alias("lang"), filled(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "lang", *[n for n, _ in FIELDS]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pieces(path)
        for piece in slices(batches, "text", PIECE_BYTES):
            yield pa.record_batch([piece.column(0), piece.column(1), *measured(piece.column(2).to_pylist(), piece.column(2), of)], names)

    spark_kinds = {pa.int64(): "bigint", pa.float64(): "double", pa.string(): "string"}
    fields = ", ".join(f"{n} {spark_kinds[t]}" for n, t in FIELDS)
    out = rows.mapInArrow(work, f"key {kind}, lang string, {fields}")
    return out.withColumnRenamed("key", key)


def corpus_bands(rows: DataFrame, bands: Bands) -> DataFrame:
    """Limits for each group and length class, from all documents that have tokens.

    Equal measures count once, so copies do not draw the quartiles together, and no deviation is taken smaller
    than what chance gives texts of that length.  Small groups get wider bands (by 10 over their size).
    """
    values = ["fertility", "fallback", "entropy"]
    rows = rows.where("n_tokens > 0").select("band", "class", *values).distinct()
    quartiles = [F.percentile_approx(v, [0.25, 0.5, 0.75], 1000).alias(v) for v in values]
    found = rows.groupBy("band", "class").agg(F.count("*").alias("size"), *quartiles)
    chance = 1 / F.sqrt(F.pow(F.lit(2.0), F.col("class")) * 1.4)
    wider = 1 + 10 / F.col("size")

    def q(v: str, i: int) -> Column:
        return F.col(v)[i]

    spread = F.greatest((q("fertility", 2) - q("fertility", 0)) / 1.349, 1.2 * chance) * wider * bands.fertility
    below = F.greatest((q("entropy", 2) - q("entropy", 1)) / 0.6745, 2 * chance) * wider * bands.entropy
    above = F.greatest((q("fallback", 2) - q("fallback", 0)) / 1.349, F.lit(0.02)) * wider * bands.fallback
    return found.select(
        "band", "class", (q("fertility", 1) - spread).alias("low_fertility"), (q("fertility", 1) + spread).alias("high_fertility"),
        (q("entropy", 1) - below).alias("low_entropy"), (q("fallback", 1) + above).alias("high_fallback"),
    )


def judge(docs: DataFrame, path: str, bands: Bands = Bands(), key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """Counts, measures and verdict of every text.

    `key`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, `base_failed` (fewer than 20 words, or more
    than 30 % of them in repeated windows of 8), `kept` (false if base_failed or outside a band), `n_tokens`, `fertility`,
    `fallback`, `entropy` (null without tokens), `reasons`.  Null text counts as empty: no words, base_failed.  Where
    `lang` is no code of two or three letters the script stands for it.  Repeated rows give rows each; other columns
    are left out; an empty table gives an empty one.  The bands are at most 26 ** 3 + 26 ** 2 languages and ten scripts
    times some 60 length classes, whatever the input, so they are broadcast.
    """
    tokens = F.col("n_tokens")
    rows = measures(docs, path, key, text, lang).select(
        "*", F.when(tokens > 0, F.col("word_chars") / tokens).alias("fertility"), F.when(tokens > 0, F.col("n_fallback") / tokens).alias("fallback"),
        F.when(F.col("lang").rlike(LANGUAGE), F.col("lang")).otherwise(F.concat(F.lit("script "), "script")).alias("band"),
        F.floor(F.log2(F.greatest(tokens, F.lit(1)))).alias("class"),
    )
    rows = written(rows.withColumn("entropy", F.when(tokens > 0, F.col("entropy"))), "measures")
    limits = F.broadcast(corpus_bands(rows, bands))
    rows = rows.join(limits, ["band", "class"], "left")
    b = bands
    tests = {
        "fertility": (F.col("fertility") < F.greatest("low_fertility", F.lit(b.least_fertility))) | (F.col("fertility") > F.least("high_fertility", F.lit(b.most_fertility))),
        "fallback": F.col("fallback") > F.least("high_fallback", F.lit(b.most_fallback)),
        "entropy": F.col("entropy") < F.greatest("low_entropy", F.lit(b.least_entropy)),
    }
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("reasons", reasons).select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.size("reasons") == 0)).alias("kept"),
        "n_tokens", "fertility", "fallback", "entropy", "reasons",
    )
