"""LM scores: base against plain Python, gradients, and held-out gain."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import edge_docs, no_docs, texts_of  # noqa: F401

from logonlens.llm import gru_lm

TABLE = "/root/testdata/sf0.01"


def plain_base(docs):
    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + [None]

    out = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs}
    counts = Counter(w for i, t in docs if not out[i] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, out[i], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6))
                   for i, t in docs), key=str)


def bases(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in rows), key=str)


def test_base_counts_and_held_out_gain(spark):
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    rows = gru_lm.lm_scores(docs, known=3000).collect()     # most words go by the shuffle
    assert bases(rows) == plain_base(texts_of(docs))
    held = [r for r in rows if r.held_out]
    base, model = (sum(getattr(r, k) for r in held) / sum(r.n_tokens for r in held) for k in ("base_score", "score"))
    assert model > base + 0.01, (base, model)


def test_edge_cases(spark, edge_docs, no_docs):
    rows = gru_lm.lm_scores(edge_docs, rounds=1).collect()
    assert bases(rows) == plain_base(texts_of(edge_docs))
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert gru_lm.lm_scores(no_docs, rounds=1).count() == 0
    only = edge_docs.where("doc_id = 9 or doc_id = 1")      # whatever is held out, scores are finite
    assert all(math.isfinite(r.score) for r in gru_lm.lm_scores(only, rounds=1).collect())


@pytest.fixture
def small():
    voc = gru_lm.Vocabulary(["", *(f"w{k}" for k in range(300))], [50, *range(400, 100, -1)], 90_000, 5_000)
    rng = np.random.default_rng(0)
    w = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float64) for k, v in gru_lm.initial(voc).items()}
    return w, rng


def test_gradients(small):
    w, rng = small
    trainer = gru_lm.Trainer(w)
    seen = {}
    trainer._update = lambda grads, n: seen.update({k: v.copy() for k, v in grads.items()})
    docs = [rng.choice([*range(300), gru_lm.HEAD], n) for n in (7, 5, 2)]
    trainer.texts(docs, 0)

    def loss(weights):
        return -math.log(10) * gru_lm.score_texts(weights, docs, 0).sum()

    for name in gru_lm.SHAPES:
        flat = [k for k in np.argsort(-np.abs(seen[name]).ravel())[:3]]
        for k in flat:
            moved = {n: v.copy() for n, v in w.items()}
            moved[name].ravel()[k] += 1e-5
            up = loss(moved)
            moved[name].ravel()[k] -= 2e-5
            assert abs((up - loss(moved)) / 2e-5 - seen[name].ravel()[k]) < 1e-3 * max(1, abs(seen[name].ravel()[k]))


def test_probabilities_sum_to_one_and_state_is_carried(small):
    w, _ = small
    first = [np.array([5, 9, y]) for y in [*range(gru_lm.HEAD), gru_lm.HEAD]]
    scores = gru_lm.score_texts(w, first, 0)
    prefix = gru_lm.score_texts(w, [np.array([5, 9])], 0)[0]
    assert abs(sum(10 ** (scores - prefix)) - 1) < 1e-6
    long = np.arange(200) % 50
    assert abs(gru_lm.score_texts(w, [long, long[:3]], 0)[0] - gru_lm.score_texts(w, [long], 0)[0]) < 1e-6


def trained_on(spark, texts, rounds):
    """The vocabulary of ``texts``, and whether training moved the input vector of each word."""
    counts = Counter(w for t in texts for w in [*t.split(), ""])
    words = sorted(counts, key=lambda w: (-counts[w], w))
    voc = gru_lm.Vocabulary(words, [counts[w] for w in words], sum(counts.values()), len(words))
    rows = spark.createDataFrame([(t.encode(), k) for k, t in enumerate(texts)], "text binary, h long")
    rng = np.random.default_rng(1)      # from the unigram model the first update would leave the inputs alone
    before = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in gru_lm.initial(voc).items()}
    after = gru_lm.train(rows, spark.sparkContext.broadcast(voc), before, rounds)
    return words, (before["x"][:len(words)] != after["x"][:len(words)]).any(axis=1)


@pytest.mark.parametrize("rounds", [1, 3])
def test_every_word_of_long_texts_is_trained_on(spark, rounds):
    texts = [" ".join(f"w{k}x{i}" for i in range(600)) for k in range(3)]
    words, moved = trained_on(spark, texts, rounds)
    assert len(words) == 1801 and moved.all(), (moved.sum(), len(moved))


def test_more_texts_than_places_all_tokens_count(small, monkeypatch):
    monkeypatch.setattr(gru_lm, "TRAIN_TEXTS", 3)
    w, rng = small
    docs = [rng.integers(0, 300, n) for n in (40, 1, 16, 100, 3, 17, 33)]
    trainer = gru_lm.Trainer(w)
    trainer.texts(iter(docs), 0)
    assert trainer.tokens == sum(map(len, docs))


def test_state_is_carried_from_window_to_window_in_training(small, monkeypatch):
    w, rng = small
    seen, docs = [], [rng.integers(0, 300, n) for n in (70, 45)]
    whole, output = gru_lm.score_texts(w, docs, 0).sum(), gru_lm.output

    def loss(*args):
        log_p, back = output(*args)
        seen.append(log_p.sum())
        return log_p, back

    monkeypatch.setattr(gru_lm, "output", loss)
    monkeypatch.setattr(gru_lm, "UPDATE_TOKENS", 10_000)
    gru_lm.Trainer(w).texts(docs, 0)
    assert len(seen) == 5 and abs(sum(seen) / np.log(10) - whole) < 1e-4


def test_classes_follow_the_vocabulary():
    small, large = (gru_lm.Vocabulary([f"w{k}" for k in range(20_000)], [5] * 20_000, 10 ** 9, n) for n in (80_000, 81 * 80_000))
    assert (small.classes, small.class_words) == (gru_lm.CLASSES, gru_lm.CLASS_WORDS)
    assert (large.classes, large.class_words, large.head) == (96, 192, 96 * 192)
    w = gru_lm.initial(large)
    packed = gru_lm._unpack(gru_lm._pack(w), large.classes, large.class_words)
    assert all((packed[k] == w[k]).all() for k in w)
    scores = gru_lm.score_texts(w, [np.array([y]) for y in range(large.head + 1)], 0)
    assert abs(sum(10 ** scores) - 1) < 1e-4


def test_softmax_with_and_without_a_shift(small, monkeypatch):
    """Small logits need no shift, large ones get one; both give the same."""
    w, rng = small
    states, y = np.tanh(rng.normal(0, 2, (400, gru_lm.HIDDEN))), rng.integers(0, gru_lm.HEAD + 1, 400)
    both = []
    for largest in (60.0, 0.0):
        monkeypatch.setattr(gru_lm, "LARGEST", largest)
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        both.append((*gru_lm.output(w, states, y, grads), *(grads[k] for k in ("wc", "bc", "ww", "bw"))))
    assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(*both, strict=True))
    large = {k: v * (1000 if k in ("wc", "ww") else 1) for k, v in w.items()}
    monkeypatch.setattr(gru_lm, "LARGEST", 60.0)
    assert not gru_lm._small(large) and np.isfinite(gru_lm.output(large, states, y)[0]).all()


def test_training_stays_in_single_precision(small):
    w, rng = small
    seen = []
    trainer = gru_lm.Trainer({k: v.astype(np.float32) for k, v in w.items()})
    sqrt = np.sqrt
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gru_lm.np, "sqrt", lambda x, *a: seen.append(getattr(x, "dtype", None)) or sqrt(x, *a))
        trainer.texts([rng.integers(0, 300, 50)], 0)
    assert seen and all(d in (None, np.float32) for d in seen)


def test_words_split_by_arrow_are_those_of_bytes():
    texts = [b" A  b\x0bC\x0c", b"", b" \t\n", "x\x1cy\x85 Äß z".encode(), b"one", b"\r\nlast One "]
    words, lengths = gru_lm.words_of(pa.chunked_array([pa.array(texts, pa.binary())]))
    plain = [t.lower().split() for t in texts]
    assert [w.encode() for w in words.to_pylist()] == sum(plain, []) and lengths.tolist() == list(map(len, plain))
    ids = gru_lm.with_ends(np.arange(len(words)), lengths, -1)
    assert [len(d) - 1 for d in ids] == lengths.tolist() and all(d[-1] == -1 for d in ids)


def test_portions_hold_all_rows_in_order():
    texts = [b"x" * (k * 7 % 11) for k in range(50)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k:k + 13], pa.binary())], ["text"]) for k in range(0, 50, 13)]
    for rows, size in ((4, 10 ** 9), (100, 20), (100, 10 ** 9), (1, 1)):
        parts = [p.column(0).to_pylist() for p in gru_lm.portions(batches, 0, rows, size)]
        assert sum(parts, []) == texts
        assert all(len(p) <= rows and sum(map(len, p[:-1])) < size for p in parts)


def test_small_windows_go_back_side_by_side(small, monkeypatch):
    """The windows of an update take one pass back, with the gradients of each one's own."""
    w, rng = small
    docs = [rng.integers(0, 300, n) for n in (70, 45, 3, 16, 33)]
    got = []
    for tokens in (1, 10_000):
        monkeypatch.setattr(gru_lm, "UPDATE_TOKENS", tokens)
        trainer, seen = gru_lm.Trainer(w), []

        def update(grads, n, trainer=trainer, seen=seen):
            seen.append({k: g.copy() for k, g in grads.items()})
            trainer.waiting = 0
            for g in grads.values():
                g[:] = 0

        trainer._update = update
        trainer.texts(iter(docs), 0)
        got.append(seen)
    assert len(got[0]) == 5 and len(got[1]) == 1
    for k in gru_lm.SHAPES:
        assert np.allclose(sum(g[k] for g in got[0]), got[1][0][k], atol=1e-10)


def test_ended_texts_leave_the_tokens_kept(small, monkeypatch):
    w, rng = small
    docs, seen = [rng.integers(0, 300, n) for n in (40, 1, 16, 100, 3, 17, 33)], []
    monkeypatch.setattr(gru_lm, "TRAIN_TEXTS", 3)
    for kept in (10, 10 ** 6):
        monkeypatch.setattr(gru_lm, "FLAT", kept)
        trainer = gru_lm.Trainer(w)
        trainer.texts(iter(docs), 0)
        seen.append(trainer.w)
    assert all((seen[0][k] == seen[1][k]).all() for k in w)
