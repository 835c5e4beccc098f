"""Byte-level BPE through a sentencepiece model that is serialised directly from a rank file.

Every token of the rank file becomes one piece: its bytes mapped to letters one by one, its score the
negative rank.  Normalisation is the identity and no prefix is added, so the library's merge order (best
score first, leftmost on ties) is the order of the ranks.  One more piece, which no text can reach, is the
unknown piece that the library insists on.  Pre-tokens are cut by the vocabulary's pattern and encoded one
by one; decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spolia.llm.chunks import ChunkCache, byte_letters, packed
from spolia.llm.common import filled, map_arrow

CACHED_CHUNKS = 200_000

# Field numbers and kinds of the sentencepiece model format.
_VARINT, _BYTES, _FLOAT = 0, 2, 5
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens[k] for k in range(len(tokens))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, kind: int, value: bytes | int | float) -> bytes:
    head = _varint(number << 3 | kind)
    if kind == _VARINT:
        return head + _varint(int(value))
    if kind == _FLOAT:
        return head + struct.pack("<f", value)
    return head + _varint(len(value)) + value


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece ids are the ranks of `tokens`."""
    letters = byte_letters()

    def piece(name: str, score: float, kind: int) -> bytes:
        body = _field(1, _BYTES, name.encode()) + _field(2, _FLOAT, score) + _field(3, _VARINT, kind)
        return _field(1, _BYTES, body)

    pieces = [piece("".join(letters[b] for b in token), -float(rank), _NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(piece("<unk>", 0.0, _UNKNOWN))
    trainer = _field(3, _VARINT, _BPE) + _field(4, _VARINT, len(pieces)) + _field(40, _VARINT, len(tokens))
    normalizer = _field(1, _BYTES, b"identity") + b"".join(_field(k, _VARINT, 0) for k in (3, 4, 5))
    return b"".join(pieces) + _field(2, _BYTES, trainer) + _field(3, _BYTES, normalizer)


class PieceCodec:
    """Encoder and decoder of one rank file; one per Python worker."""

    def __init__(self, path: str, pattern: str) -> None:
        self.tokens = read_ranks(path)
        self.whole = {token: rank for rank, token in enumerate(self.tokens)}
        model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        table = dict(enumerate(byte_letters()))
        cut = regex.compile(pattern)

        def pretoken(piece: str) -> bytes:
            raw = piece.encode()
            rank = self.whole.get(raw)  # a pre-token that is a token needs no merges
            ids = [rank] if rank is not None else model.encode(raw.decode("latin-1").translate(table))
            return packed(ids)

        def whole(text: str) -> bytes:
            return b"".join(pretoken(m.group()) for m in cut.finditer(text))

        self.cache = ChunkCache(pretoken, whole, CACHED_CHUNKS)

    def encode(self, text: str) -> bytes:
        return self.cache.encode(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> PieceCodec:
    return PieceCodec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `ids` (little-endian unsigned 32-bit integers) and `n_tokens` of every text.

    Null counts as an empty text and has no ids; repeated rows are encoded each; other columns are left out.
    """
    rows = df.select(F.col(key).alias("key"), filled(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = codec(path, pattern)
        ids = [of.encode(x) for x in batch.column(1).to_pylist()]
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        return pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), counts], ["key", "ids", "n_tokens"])

    out = map_arrow(rows, work, f"key {kind}, ids binary, n_tokens bigint")
    return out.select(F.col("key").alias(key), "ids", "n_tokens")


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """`key`, `ids`, `n_tokens` as `encode` gives them, and `decoded`: the bytes that the ids stand for."""
    rows = df.select(F.col(key).alias("key"), "ids", "n_tokens")
    kind = rows.schema["key"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = codec(path, pattern)
        texts = pa.array([of.decode(x) for x in batch.column(1).to_pylist()], pa.binary())
        return pa.record_batch([*batch.columns, texts], ["key", "ids", "n_tokens", "decoded"])

    out = map_arrow(rows, work, f"key {kind}, ids binary, n_tokens bigint, decoded binary", text="ids")
    return out.select(F.col("key").alias(key), "ids", "n_tokens", "decoded")


def digest(df: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Per document: number of ids, checksum of the ids, checksum of the decoded bytes; on request the ids too."""
    sums = [F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return decode(encode(df, path, pattern), path, pattern).select("doc_id", "n_tokens", *sums, *["ids"] * keep_ids)
