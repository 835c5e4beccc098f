import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spolia.llm import bpe_pieces as B
from spolia.llm.queries import RANKS

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
TEXTS = ["", " ", "1st a", "a  b", "\n\n x\n", "it's  \t we'll", "ÄÖ ß, é.", "x" * 3000, "日本語 と 한국어", "a\x1cb \x85 c\xa0d", "🙂 🙂🙂",
         "abc123 45.6", "<|endoftext|> <unk> ▁x", "é ‍", "no.\nYes, so", " lead", "trail ", "²³ ½", "\x00\x01"]


@pytest.fixture(scope="module")
def known():
    ranks = {token: rank for rank, token in enumerate(B.read_ranks(PATH))}
    return tiktoken.Encoding("known", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_library(known, text):
    of = B.codec(PATH, PATTERN)
    ids = of.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == known.encode_ordinary(text)
    assert of.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs", "Cn", "Co"]), st.sampled_from(" \n\t'.,sSt1é"))))
def test_random_texts(text):
    ranks = {token: rank for rank, token in enumerate(B.read_ranks(PATH))}
    known = test_random_texts.__dict__.setdefault(
        "known", tiktoken.Encoding("known", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
    of = B.codec(PATH, PATTERN)
    assert np.frombuffer(of.encode(text), "<u4").tolist() == known.encode_ordinary(text)


def test_rows(spark, known):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (0, None), (0, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = {(r.doc_id, r.ids_sha256, r.decoded_sha256, r.n_tokens) for r in B.digest(df, PATH, PATTERN).collect()}
    want = set()
    for key, text in rows:
        ids = np.array(known.encode_ordinary(text or ""), "<u4").tobytes()
        want.add((key, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), len(ids) // 4))
    assert got == want
    assert B.digest(df, PATH, PATTERN).count() == len(rows)
    assert B.digest(df.limit(0), PATH, PATTERN).count() == 0
