import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spolia.llm import token_files as T
from spolia.llm.elias_fano import EliasFano
from spolia.llm.queries import TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)
TEXTS = ["a <|endoftext|> b", "x<|endoftext|>y<|endoftext|>\n<|endoftext|>", " <|endoftext|>  <|endoftext ", "it's<|endoftext|>é", "", " ", "1st a", "a  b", "\n\n x\n", "it's  \t we'll", "ÄÖ ß, é.", "日本語 と 한국어", "a\x1cb \x85 c\xa0d", "🙂 🙂", "<|endoftext|> x", "word, word."]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano(steps):
    values = np.cumsum(steps) if steps else np.zeros(0, np.int64)
    of = EliasFano.from_bytes(EliasFano.build(values).to_bytes())
    assert of.all().tolist() == values.tolist()
    assert [of.select(k) for k in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.full(10_000, 700))
    assert len(EliasFano.build(values).to_bytes()) * 8 / 10_000 < 2.6 + np.log2(700)
    with pytest.raises(ValueError):
        EliasFano.build(np.array([3, 2]))


def test_shards(spark, tmp_path):
    known = Tokenizer.from_file(PATH)
    rows = [(5 * i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (0, None), (7, "again"), (7, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit("clash")).repartition(5)
    T.write_shards(df, f"{tmp_path}/s", PATH, shard_ids=12)
    got = T.read_documents(spark, f"{tmp_path}/s").orderBy("start").collect()
    assert [r.key for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    start, seen = 0, []
    for r in got:
        assert r.start == start
        start += r.n_tokens
        seen.append((r.key, r.n_tokens, r.ids_crc32))
    want = []
    for k, t in rows:
        ids = [*known.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(map(str, seen)) == sorted(map(str, want))
    T.write_shards(df.limit(0), f"{tmp_path}/none", PATH)
    assert T.read_documents(spark, f"{tmp_path}/none").count() == 0
