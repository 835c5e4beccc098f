import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as P
from spolia.llm import bpe_pieces
from spolia.llm.common import DOCUMENT_COLUMNS


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of two sources with toxic ones, near copies and secrets; labels for most."""
    rng = random.Random(8)
    folder = tmp_path_factory.mktemp("sf")
    parts = ["lo", "ra", "mi", "ten", "sho", "ka", "bru", "vi"]
    rows, labels = [], []
    for k in range(500):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(30, 90))]
        toxic = k % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["vexgrub", "zorwit"]))
        if k % 50 == 1:
            words.append("password=hunter22")
        rows.append((k, " ".join(words), "en", rng.choice(["a", "a", "b", None]), 1))
        labels.append((k, 1, int(toxic)))
    for k in range(500, 540):  # near copies of clean documents: one word added
        of = rows[(k - 500) * 5 + 2]
        rows.append((k, of[1] + " end", "en", "a", 1))
    rows += [(540, None, None, None, None), (541, "", "en", "b", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, dict((k, t) for k, _, t in labels)


def test_stages_one_by_one(spark, tables):
    folder, rows, toxic = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs.withColumn("extra", F.lit(1)), folder)
        assert out.columns == list(DOCUMENT_COLUMNS), name
        kept.append(out.collect())
        docs = spark.createDataFrame(kept[-1], docs.schema)
    clean = {r.doc_id for r in kept[0]}
    wrong = sum((toxic.get(k) == 1) == (k in clean) for k, *_ in rows if k < 500)
    assert wrong <= 5 and clean >= set(range(500, 542)) - {k for k in range(500, 540) if (k - 500) * 5 + 2 not in clean}
    one = {r.doc_id for r in kept[1]}
    for k in range(500, 540):
        assert not {k, (k - 500) * 5 + 2} <= one
    assert one >= {k for k in clean if k < 500} and {540, 541} <= one
    assert {r.doc_id for r in kept[2]} == one
    assert not any("hunter22" in (r.text or "") for r in kept[2]) and sum("[secret]" in (r.text or "") for r in kept[2]) > 5
    before = {r.doc_id: r.text for r in kept[2]}
    assert kept[3] and all(before[r.doc_id] == r.text for r in kept[3])


def test_run(spark, tables):
    folder, _, _ = tables
    out = P.run(spark, folder).collect()
    assert out == P.run(spark, folder).collect() or sorted(map(str, out)) == sorted(map(str, P.run(spark, folder).collect()))
    tokens = bpe_pieces.read_ranks(P.public_tokenizers.path(P.RANKS))
    known = tiktoken.Encoding("known", pat_str=P.public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        text = known.decode_bytes(ids)
        assert len(ids) == r.n_tokens and known.encode_ordinary(text.decode()) == ids
        assert r.decoded_sha256 == hashlib.sha256(text).hexdigest() and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()


