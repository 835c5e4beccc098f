import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from spolia.llm import attention as A
from spolia.llm import lm_scoring as L
from spolia.llm.queries import RANKS

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def corpus(n, seed):
    rng = random.Random(seed)
    parts = [["the", "of", "wh", "ing", "er", "tion"], ["der", "und", "sch", "heit", "ung", "ß"]]
    rows = []
    for k in range(n):
        own = parts[k % 2]
        words = [rng.choice(own) if rng.random() < 0.5 else "".join(rng.choices(own, k=2)).title() for _ in range(rng.randint(0, 90))]
        rows.append((k, " ".join(words)))
    return rows


def test_base_and_held_out_gain(spark):
    rows = corpus(400, 1) + [(None, None), (1000, ""), (1000, ""), (1001, "Zzz\x0bÄä \x1c " * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit("clash")).repartition(4)
    got = L.score(df, PATH, PATTERN).collect()
    assert len(got) == len(rows)
    out = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    counts = Counter()
    for k, t in rows:
        if not out(k):
            counts.update([*L.word_list(t or ""), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for k, t in rows:
        tokens = [*L.word_list(t or ""), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((str(k), out(k), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_meet_their_counts_in_the_join(spark, monkeypatch):
    rows = corpus(60, 2)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    one = {r.doc_id: r for r in L.score(df, PATH, PATTERN).collect()}
    monkeypatch.setattr(L, "FREQUENT", 5)
    model = L.fit(df, L.word_counts(df.where(~L.held_out()).select("text")), PATH, PATTERN)
    assert len(model.words) <= 5
    for r in L.score(df, PATH, PATTERN).collect():
        assert (r.n_known, r.n_tokens) == (one[r.doc_id].n_known, one[r.doc_id].n_tokens)
        assert r.base_score == pytest.approx(one[r.doc_id].base_score, abs=1e-6)


def test_blocks_do_not_change_scores():
    rng = np.random.default_rng(3)
    shape = (A.SYMBOLS, A.WIDTH)
    w = A.Weights(*[rng.normal(0, 1, s).astype(np.float32) for s in (shape, shape, shape, (2 * A.STRIDE,), (A.WIDTH, A.CLASSES), (A.SYMBOLS, A.CLASSES))])
    lengths = [1, 5, 40, 100, 3]
    symbols = rng.integers(0, A.SYMBOLS, sum(lengths))
    starts = np.repeat(np.cumsum([0, *lengths[:-1]]), lengths)
    targets = rng.integers(0, A.CLASSES, len(symbols))
    got = A.class_log_probabilities(w, symbols, starts, targets)
    for p in range(len(symbols)):  # plain: one query at a time
        block = p // A.STRIDE * A.STRIDE
        keys = np.arange(max(starts[p], block - A.STRIDE), p + 1)
        s = np.exp(w.key[symbols[keys]] @ w.query[symbols[p]] + w.distance[p - keys])
        logits = (s / s.sum()) @ w.value[symbols[keys]] @ w.out + w.table[symbols[p]]
        assert got[p] == pytest.approx(logits[targets[p]] - np.log(np.exp(logits).sum()), abs=2e-3)


def test_gradients():
    rng = np.random.default_rng(5)
    shape = (A.SYMBOLS, A.WIDTH)
    w = A.Weights(*[rng.normal(0, 0.3, s) for s in (shape, shape, shape, (2 * A.STRIDE,), (A.WIDTH, A.CLASSES), (A.SYMBOLS, A.CLASSES))])
    symbols, targets = rng.integers(0, 9, 4 * A.STRIDE), rng.integers(0, A.CLASSES, 4 * A.STRIDE)
    starts = np.repeat([[0], [5]], 2 * A.STRIDE, axis=1).ravel()

    def loss():
        total = 0.0
        for k in range(2):
            s = symbols[32 * k : 32 * k + 32]
            logits, _ = A.forward(w, s, starts[32 * k : 32 * k + 32])
            p = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
            total -= p[np.arange(A.STRIDE), targets[32 * k + A.STRIDE : 32 * k + 32]].sum()
        return total / (2 * A.STRIDE)

    for part, gradient in zip(w.parts(), A._gradients(w, symbols, starts, targets), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before, step = part[at], 1e-4
        part[at] = before + step
        up = loss()
        part[at] = before - step
        down = loss()
        part[at] = before
        assert gradient[at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=1e-5)


def test_small_tables(spark):
    df = spark.createDataFrame([(k, "a b") for k in range(1)], "doc_id bigint, text string")
    assert L.score(df, PATH, PATTERN).count() == 1
    assert L.score(df.limit(0), PATH, PATTERN).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = L.score(spark.createDataFrame([(held, "a b")], "doc_id bigint, text string"), PATH, PATTERN).collect()
    assert (row.n_known, row.train_tokens, row.base_score) == (0, 0, 0.0) and math.isfinite(row.score)


def test_attention_learns_from_all_training_texts(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_SYMBOLS", 2000)
    rows = [(k, f"the {chr(0x4E00 + k)} of") for k in range(1600)]  # the middle one in this text only
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    learned = df.where(~L.held_out())
    model = L.fit(df, L.word_counts(learned.select("text")), PATH, PATTERN)
    words = [w for r in learned.collect() for w in L.word_list(r.text)]
    tokens, _ = L.split_words(words, PATH, PATTERN)
    assert (model.classes[tokens] < A.CLASSES - 2).all()
    shards = L.shards_of(learned.select("text"), model.words, PATH, PATTERN)
    totals = np.bincount(tokens, minlength=len(model.classes)).astype(float)
    totals[-1] = model.ends
    near = L.class_neighbours(shards, totals)
    the = tokens[0]
    assert near[the][A.frequent_of(totals)[-1]] == model.ends  # the end of a text, or its beginning, before every "the"


def test_long_unbroken_texts_keep_their_cost(spark):
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefghij0123456789", k=50_000))
    df = spark.createDataFrame(corpus(60, 3), "doc_id bigint, text string")
    model = L.fit(df, L.word_counts(df.where(~L.held_out()).select("text")), PATH, PATTERN)
    log = []
    for text in (long, long[:5_000]):
        tokens, lengths = L.split_words([text.encode()], PATH, PATTERN)
        logs, _ = model.word_logs(lengths, tokens, np.array([0, 1]))
        log.append(float(model.mixed(logs, np.zeros(1))[0]))
    assert log[0] < 8 * log[1] < -8 * 305
    assert model.mixed(np.array([-3000.0]), np.array([5.0]))[0] == pytest.approx(math.log10((1 - model.mixture) * 6 / (model.n + model.v + 1)))
    keys = [k for k in range(5000, 5100) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    both = df.union(spark.createDataFrame([(keys[0], long), (keys[1], long[:5_000])], df.schema))
    got = {r.doc_id: r.score for r in L.score(both, PATH, PATTERN).collect()}
    assert got[keys[0]] < 8 * got[keys[1]] < -8 * 305


def test_rounds_go_through_every_block(spark):
    """Each symbol moves its weights, also those that stand in one block of a long shard only."""
    rng = random.Random(4)
    words = [f"{chr(0x4E00 + 7 * k)}{rng.choice('abcdefgh')}" for k in range(60)]
    texts = [(words[k // 10] if k % 10 == 5 else "the of and to in a is that for it",) for k in range(600)]
    df = spark.createDataFrame(texts, "text string").coalesce(1)
    size = len(L.read_ranks(PATH))
    classes = np.append(np.arange(size) % (A.CLASSES - 2), A.CLASSES - 1)
    shards = L.shards_of(df, [], PATH, PATTERN)
    seen = []
    for tokens, lengths, sizes in shards.collect():
        before = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
        seen.append(L.symbols_of(classes, np.frombuffer(lengths, np.int32), np.frombuffer(tokens, np.int32), before)[3])
    seen = np.unique(np.concatenate(seen))
    moved = L.trained(shards, classes).value != A.first_weights(np.ones((A.SYMBOLS, A.CLASSES))).value
    assert len(seen) > 40 and moved[seen].any(axis=1).all()


def test_texts_are_encoded_and_attended_once(spark, tmp_path):
    """The scores come from the stored probabilities of words: the texts are not read again."""
    spark.createDataFrame(corpus(40, 6), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents"))
    got = L.score(spark.read.parquet(str(tmp_path / "documents")), PATH, PATTERN)
    files = got.inputFiles()
    assert files and not any("/documents/" in f for f in files)
    assert got.count() == 40


def test_stored_shards_leave_out_what_frequent_words_tell(spark):
    rows = [*corpus(50, 7), (None, None), (900, "Ünseen wordß　x twice twice")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    words = sorted({w for _, t in rows[:20] for w in L.word_list(t)})
    known = (words, *L.split_words(words, PATH, PATTERN))
    shared = spark.sparkContext.broadcast(known)
    narrow, whole = (L.encoded(df, known, PATH, PATTERN, whole).toArrow().combine_chunks().to_batches()[0] for whole in (False, True))
    assert narrow.num_rows == 2 and narrow.select(["learned", "keys", "sizes", "at", "others"]) == whole.select(["learned", "keys", "sizes", "at", "others"])
    texts = {k: t or "" for k, t in rows}
    for row, (lengths, tokens, before), (all_lengths, all_tokens, _) in zip(narrow.to_pylist(), L.shard_arrays(narrow, shared), L.shard_arrays(whole, None), strict=True):
        want = [L.word_list(texts[k]) for k in row["keys"]]
        ids, sizes = L.split_words([w for ws in want for w in ws], PATH, PATTERN)
        assert tokens.tolist() == all_tokens.tolist() == ids.tolist() and lengths.tolist() == all_lengths.tolist() == sizes.tolist()
        assert np.diff(before).tolist() == [len(ws) for ws in want]
        assert row["others"] == [w for ws in want for w in ws if w not in words] and len(row["tokens"]) < ids.nbytes


@pytest.mark.parametrize("far", [1.0, 40.0])
def test_gradients_by_classes_in_pieces(far):
    """Against whole matrices, over more symbols than a piece has, also with logits whose exponentials do not fit."""
    rng = np.random.default_rng(9)
    shape, n = (A.SYMBOLS, A.WIDTH), 2 * A.PIECE + 37
    w = A.Weights(*[rng.normal(0, 0.3, s) for s in (shape, shape, shape, (2 * A.STRIDE,), (A.WIDTH, A.CLASSES))], far * rng.normal(0, 1, (A.SYMBOLS, A.CLASSES)))
    flat, own = rng.normal(0, 0.3, (n, A.WIDTH)), rng.integers(0, 40, n)
    targets, weight = rng.integers(0, A.CLASSES, n), rng.random(n)
    logits = flat @ w.out + w.table[own]
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), targets] -= 1
    p *= weight[:, None]
    table = np.zeros_like(w.table)
    for k in range(n):
        table[own[k]] += p[k]
    for got, want in zip(A._output_gradients(w, flat, own, targets, weight), (p @ w.out.T, flat.T @ p, table), strict=True):
        assert np.allclose(got, want, atol=1e-9)
