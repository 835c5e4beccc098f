import math
import random
import re
from collections import Counter
from statistics import median

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from spolia.llm import quality_rules as Q

PATH = public_tokenizers.path("piece_bpe_32k.model")
KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    tokens = [t for w in words for t in model.encode(w)]
    counts = Counter(tokens)
    bits = -sum(n / len(tokens) * math.log2(n / len(tokens)) for n in counts.values()) if tokens else None
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside),
            len(words) < 20 or 100 * len(inside) > 30 * len(words), len(tokens), sum(model.is_byte(t) for t in tokens), bits)


def some_texts():
    rng = random.Random(8)
    words = ["the", "of", "naïve", "#tag", "日本語", "𝒳𝒴", "a|b", " x", " ", "x" * 300, "é́", "ﷺ", "\x00", "\x1c"]
    texts = ["", None, " \n\t ", "\n\n\n", "one", "a\nb\na\n \na\n", "same words here " * 40, "\x85line\x85", "x\x0by\x0cz\rw"]
    texts += [rng.choice(["", "\n", "  "]).join(rng.choice(words) + rng.choice([" ", "\n", "\t", " \n"]) for _ in range(rng.randrange(120))) for _ in range(60)]
    phrase = [f"w{k}" for k in range(9)]
    texts += [" ".join(phrase + [f"u{k}" for k in range(30)] + phrase[: 7 + k]) for k in range(3)]
    return texts + ["日本語のテキスト" * 30, " ".join(f"n{k % 977}" for k in range(60_000))]


def test_counts_and_measures_against_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(Q, "PIECE_BYTES", 700)
    texts = some_texts()
    df = spark.createDataFrame([(k, t, "en", "s", None) for k, t in enumerate(texts)], KIND).withColumn("key", F.lit(1)).withColumn("class", F.lit("clash"))
    rows = {r.doc_id: r for r in Q.measures(df, PATH).collect()}
    got = {r.doc_id: r for r in Q.judge(df, PATH).collect()}
    assert len(got) == len(rows) == len(texts)
    for k, text in enumerate(texts):
        *counts, tokens, fallback, bits = plain(text)
        r = got[k]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] == counts
        assert (rows[k].n_tokens, rows[k].n_fallback) == (tokens, fallback)
        assert (r.entropy is None) == (bits is None) and (bits is None or r.entropy == pytest.approx(bits, abs=1e-9))
        assert not (r.base_failed and r.kept)


def test_table_of_words_is_emptied(spark, monkeypatch):
    model = Q.Pieces(PATH)
    one = model.words([b"alpha", b"beta", b"alpha"])
    assert one.tolist() == [0, 1, 0] and model.words([b"beta", b"gamma"]).tolist() == [1, 2]
    assert model.flat[model.starts[2] : model.starts[3]].tolist() == model.model.encode("gamma")
    monkeypatch.setattr(Q, "CACHED_BYTES", 10)
    import pyarrow as pa

    text = ["delta delta"]
    Q.measured(text, pa.array(text), model)
    assert list(model.ids) == [b"delta"]


@pytest.mark.parametrize("window", [1, 2, 3, 5, 8])
def test_repeated_windows(window):
    rng = random.Random(window)
    docs = np.repeat(np.arange(6), [0, 3, 40, 25, 1, 60])
    codes = np.array([rng.randrange(3) for _ in docs])
    got = Q.repeated_words(codes, docs, window)
    want = np.zeros(len(docs), bool)
    for d in range(6):
        at = np.flatnonzero(docs == d)
        windows = Counter(tuple(codes[at[i : i + window]]) for i in range(len(at) - window + 1))
        for i in range(len(at) - window + 1):
            if windows[tuple(codes[at[i : i + window]])] > 1:
                want[at[i : i + window]] = True
    assert got.tolist() == want.tolist()


def prose(rng, n, vocabulary):
    return " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=n))


def test_bands_keep_the_usual_and_reject_the_odd(spark):
    rng = random.Random(3)
    vocabularies = {lang: ["".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(900)] for lang, letters in {"aa": "abcdefgh", "bb": "éèñopqrs"}.items()}
    rows = [(k, prose(rng, 200 + k % 50, vocabularies[lang]), lang) for k, lang in enumerate(["aa", "bb"] * 300)]
    odd = [(1000 + k, " ".join(f"{rng.choice(vocabularies['aa'][:4])}{rng.randrange(10)}" for _ in range(220)), "aa") for k in range(20)]
    fallback = [(2000 + k, " ".join(rng.choices([chr(0x1F600 + j) + chr(0x10400 + j) for j in range(60)], k=200)), "aa") for k in range(5)]
    copies = [(3000 + k, rows[0][1], "aa") for k in range(400)]
    df = spark.createDataFrame([(k, t, lang, "s", 1) for k, t, lang in rows + odd + fallback + copies], KIND).repartition(6)
    got = {r.doc_id: r for r in Q.judge(df, PATH).collect()}
    assert [k for k, *_ in rows + copies if not got[k].kept] == []
    assert [k for k, *_ in odd + fallback if got[k].kept] == []
    assert all("fallback" in got[k].reasons for k, *_ in fallback)


def test_quartiles_against_exact_ones(spark):
    rng = random.Random(1)
    rows = [("aa", 6, rng.gauss(3, 0.4), 0.0, rng.gauss(6, 0.5), 90) for _ in range(801)]
    df = spark.createDataFrame(rows * 2, "band string, class bigint, fertility double, fallback double, entropy double, n_tokens bigint")
    bands = Q.Bands()
    (r,) = Q.corpus_bands(df, bands).collect()
    values = sorted(x[4] for x in rows)
    wide = bands.entropy * (1 + 10 / 801)
    assert r.low_entropy == pytest.approx(median(values) - wide * (values[600] - values[400]) / 0.6745, abs=0.1)
    values = sorted(x[2] for x in rows)
    wide = bands.fertility * (1 + 10 / 801)
    assert r.high_fertility == pytest.approx(median(values) + wide * (values[600] - values[200]) / 1.349, abs=0.1)


def test_script_stands_for_missing_languages(spark):
    texts = ["plain letters", "Ελληνικά κείμενα", "Русский текст", "日本語", "نص عربي", "12 34", "", "Straße é"]
    df = spark.createDataFrame([(k, t, [None, "", "English"][k % 3], None, None) for k, t in enumerate(texts)], KIND)
    got = [r.script for r in Q.measures(df, PATH).orderBy("doc_id").collect()]
    assert got == ["latin", "greek", "cyrillic", "cjk", "arabic", "none", "none", "latin"]
    assert Q.judge(df, PATH).count() == len(texts)
    assert Q.judge(df.limit(0), PATH).collect() == []
    assert Q.judge(df.drop("lang"), PATH, lang=None).count() == len(texts)
