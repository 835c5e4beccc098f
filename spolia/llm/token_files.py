"""Token ids of a corpus in files: one concatenated id array per shard, document boundaries in Elias-Fano code.

A shard holds the ids of consecutive documents (ascending key, nulls first) as unsigned 16-bit integers, or
32-bit ones for vocabularies above 65,536, and one Elias-Fano code of the boundaries within it.  No offset
needs 64 bits; where a shard starts in the whole corpus follows from the counts of the shards before it.
Shards are rows of a Parquet table, so that Spark's commit protocol drops what a lost executor has left, and
any file system that Spark reaches will do.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spolia.llm.chunks import ChunkCache, byte_letters, byte_names, packed
from spolia.llm.common import filled, map_arrow, slices
from spolia.llm.elias_fano import EliasFano

CACHED_CHUNKS = 600_000
SHARD_IDS = 4_000_000  # a shard is closed when it has this many ids
SHARD = "part int, seq int, n_docs bigint, n_ids bigint, width int, ids binary, bounds binary, keys array<{key}>"


class TokenEncoder:
    """Ids of a text by a tokenizers file, as its library gives them without adding special tokens; one per Python worker.

    A special token's string in a text is that token, so a word that holds one is left to the library.
    """

    def __init__(self, path: str) -> None:
        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.size = tokenizer.get_vocab_size()

        def whole(text: str) -> bytes:
            return packed(tokenizer.encode(text, add_special_tokens=False).ids)

        cut = spec.get("pre_tokenizer") or {}
        byte_level = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        added = spec.get("added_tokens") or []
        apart = tuple(t["content"] for t in added)
        plain = not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
        if byte_level and plain and not spec.get("normalizer") and spec["model"]["type"] == "BPE":
            merge, table = tokenizer.model.tokenize, dict(enumerate(byte_letters()))

            def pretoken(piece: str) -> bytes:
                return packed([t.id for t in merge(byte_names(piece, table))])

            self.encode = ChunkCache(pretoken, whole, CACHED_CHUNKS, apart=apart).encode
        else:
            self.encode = whole


@lru_cache(maxsize=2)
def encoder(path: str) -> TokenEncoder:
    return TokenEncoder(path)


def write_shards(df: DataFrame, path: str, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text",
                 shard_ids: int = SHARD_IDS) -> None:
    """Encodes every text, appends `end_id` and writes the shards of all rows to `path`.

    Null counts as empty (only its end is written); a null key comes first; rows with equal keys all stay,
    next to each other; an empty table gives an empty folder of shards.  Other columns are left out.
    """
    rows = df.select(F.col(key).alias("key"), filled(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    schema = SHARD.format(key=kind)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(tokenizer)
        width = 2 if of.size <= 1 << 16 else 4
        part, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        seq, held, keys, n_ids = 0, [], [], 0

        def shard() -> pa.RecordBatch:
            counts = np.array([len(x) // 4 for x in held], np.int64)
            ids = np.frombuffer(b"".join(held), "<u4").astype(f"<u{width}").tobytes()
            bounds = EliasFano.build(np.concatenate([[0], np.cumsum(counts)])).to_bytes()
            row = {"part": part, "seq": seq, "n_docs": len(held), "n_ids": int(counts.sum()), "width": width,
                   "ids": ids, "bounds": bounds, "keys": keys}
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(key_type)]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))

        key_type = pa.int64()
        for piece in slices(batches, "text", 1 << 20):
            key_type = piece.schema.field("key").type
            for k, x in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                ids = of.encode(x) + end
                held.append(ids)
                keys.append(k)
                n_ids += len(ids) // 4
                if n_ids >= shard_ids:
                    yield shard()
                    seq, held, keys, n_ids = seq + 1, [], [], 0
        if held:
            yield shard()

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(each, schema).write.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """`part`, `seq`, `base`: ids before each shard, from the counts of parts and then of shards in a part."""
    counts = shards.select("part", "seq", "n_ids")
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(before), F.lit(0)).alias("part_base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("inner", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    return inner.join(parts, "part").select("part", "seq", (F.col("part_base") + F.col("inner")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """`key`, `start` (ids of all documents before it), `n_tokens`, `ids_crc32` of every document in the shards."""
    shards = spark.read.parquet(path)
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [], [], [], [], [], []
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
            code = EliasFano.from_bytes(row["bounds"])
            bounds = list(map(code.select, range(code.count)))
            view = memoryview(ids).cast("B")
            for k, a, b in zip(row["keys"], bounds, bounds[1:], strict=False):
                for column, value in zip(out, (row["part"], row["seq"], k, a, b - a, zlib.crc32(view[4 * a : 4 * b])), strict=True):
                    column.append(value)
        key_type = batch.schema.field("keys").type.value_type
        types = [pa.int32(), pa.int32(), key_type, pa.int64(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(v, t) for v, t in zip(out, types, strict=True)],
                               ["part", "seq", "key", "inner", "n_tokens", "ids_crc32"])

    columns = shards.select("part", "seq", "width", "ids", "bounds", "keys")
    documents = map_arrow(columns, work, f"part int, seq int, key {kind}, inner bigint, n_tokens bigint, ids_crc32 bigint",
                          text="ids", most_bytes=1)
    return documents.join(shard_starts(shards), ["part", "seq"]).select(
        "key", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
