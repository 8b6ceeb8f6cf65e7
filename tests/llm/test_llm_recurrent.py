import collections
import math
import random
import zlib

import numpy as np
import pytest

from pergamon.llm import recurrent_lm as R


def corpus(n=400, seed=3):
    """Two languages of words of their own, and some words seen once; a model of order can tell them."""
    rng = random.Random(seed)
    words = [[f"{p}{i}" for i in range(150)] for p in "ab"]
    rows = []
    for i in range(n):
        own = words[i % 2]
        rows.append((i, " ".join(own[min(int(rng.expovariate(0.05)), 149)] for _ in range(rng.randint(1, 120))) + f" once{i}"))
    return rows + [(n, None), (n + 1, ""), (n + 2, "B1 \n b1\x0bB2"), (5, rows[5][1]), (None, "a1 a2"), (n + 3, "a1 " * 20_000)]


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").selectExpr("*", "1 as held_out", "2 as row", "3 as c", "4 as h")
    return R.language_model_scores(docs).collect()


def test_base_scores_are_those_of_plain_counts(scored):
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    texts = collections.defaultdict(list)
    for i, t in corpus():
        texts[i].append((t or "").encode().lower().split() + [None])
    c = collections.Counter(w for i, rows in texts.items() if not out(i) for t in rows for w in t)
    n, v = sum(c.values()), len(c)
    assert len(scored) == len(corpus())
    for r in scored:
        t = texts[r.doc_id][0]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(t), sum(c[w] > 0 for w in t), n)
        assert abs(r.base_score - base) < 1e-9 * abs(base)
        assert r.score < 0


def test_rare_words_by_join_give_the_same(spark, scored, monkeypatch):
    monkeypatch.setattr(R, "HEAD", 40)
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    few = {(r.doc_id, r.n_tokens): r for r in R.language_model_scores(docs).collect()}
    for r in scored:
        other = few[r.doc_id, r.n_tokens]
        assert r.n_known == other.n_known and abs(r.base_score - other.base_score) < 1e-9 * abs(r.base_score)


def test_order_helps_on_held_out_texts(scored):
    held = [r for r in scored if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_every_training_document_gives_gradients(spark, monkeypatch):
    monkeypatch.setattr(R, "SLICE_TOKENS", 5_000)
    seen = []

    def trained(samples, slices, vocabulary):
        seen.extend((r.turn, r.slice, len(r.ranks) // 4) for r in samples.collect())
        assert slices > 1
        return vocabulary.start()

    monkeypatch.setattr(R, "_trained", trained)
    rows = corpus()
    found = R.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert len(seen) == sum(zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i, _ in rows)
    assert sum(n for _, _, n in seen) == found.train_tokens
    assert {t for t, _, _ in seen} == set(range(R.ROUNDS)) and len({s for _, s, _ in seen}) > 1


def small_vocabulary(n=60):
    words = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    words[0] = R.END
    return R.Vocabulary(words, np.arange(n, 0, -1) * 10, 10_000, n + 5)


def test_probabilities_sum_to_one():
    vocabulary = small_vocabulary()
    rng = np.random.default_rng(1)
    weights = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in vocabulary.start().items()}
    weights["w"][:] = vocabulary.start()["w"]
    state = rng.normal(size=(1, R.WIDTH)).astype(np.float32)
    every = np.arange(len(vocabulary.words))
    log_p = R._log_probabilities(weights, np.repeat(state, len(every), axis=0), every, vocabulary.classes[every])
    mass = np.exp((state @ weights["C"] + weights["c"])[0].astype(float))
    used = np.unique(vocabulary.classes[every])
    assert abs(np.exp(log_p).sum() - mass[used].sum() / mass.sum()) < 1e-4


def test_gradients_are_those_of_differences(monkeypatch):
    vocabulary = small_vocabulary()
    rng = np.random.default_rng(2)
    weights = {k: (v + rng.normal(0, 0.2, v.shape)).astype(np.float64) for k, v in vocabulary.start().items()}
    ranks = rng.integers(0, 60, (5, 3))
    x, keep = vocabulary.inputs(ranks), np.ones((5, 3))
    keep[3, 1] = 0
    h, target, ones = rng.normal(size=(3, R.WIDTH)), rng.integers(0, 60, (5, 3)), np.ones((5, 3))
    monkeypatch.setattr(R.np, "float32", np.float64)  # differences need the precision

    def loss():
        states = R._steps(weights, x, keep, h)
        return -R._log_probabilities(weights, states.reshape(-1, R.WIDTH), target.ravel(), vocabulary.classes[target.ravel()]).mean()

    grads, _ = R._gradients(weights, x, keep, h, target, vocabulary.classes[target.ravel()], ones)
    for k, g in grads.items():
        for at in rng.permutation(np.argwhere(np.abs(g) > 1e-6))[:6]:
            at = tuple(at)
            kept = weights[k][at]
            weights[k][at] = kept + 1e-5
            up = loss()
            weights[k][at] = kept - 1e-5
            down = loss()
            weights[k][at] = kept
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6 + 1e-4 * abs(g[at]), k


def test_lanes_and_chunks_don_t_change_scores():
    vocabulary = small_vocabulary()
    rng = np.random.default_rng(4)
    weights = {k: v + rng.normal(0, 0.2, v.shape).astype(np.float32) for k, v in vocabulary.start().items()}
    lengths = np.array([1, 70, 3, 200, 33, 1, 64])
    ranks = rng.integers(0, 60, lengths.sum())
    together = R.log_likelihoods(weights, vocabulary, ranks, lengths)
    cuts = np.cumsum(lengths)
    alone = [R.log_likelihoods(weights, vocabulary, ranks[e - n:e], np.array([n]))[0] for n, e in zip(lengths, cuts)]
    assert np.allclose(together, alone, rtol=1e-4)


def test_pieces_of_long_documents_go_on_from_the_word_before(monkeypatch):
    vocabulary = small_vocabulary()
    seen = {}

    def gradients(weights, x, keep, h, target, classes, weight):
        seen.setdefault("x", []).append(x[weight > 0])
        seen.setdefault("fresh", []).append((keep == 0).sum())
        return {k: np.zeros_like(v) for k, v in weights.items()}, h

    monkeypatch.setattr(R, "_gradients", gradients)
    monkeypatch.setattr(R, "PIECE", 4)
    documents = [np.arange(1, 11, dtype=np.int32), np.arange(20, 24, dtype=np.int32), np.array([30], np.int32)]
    R.train(vocabulary.start(), vocabulary, documents)
    end = vocabulary.inputs(vocabulary.find(np.array([R.END], np.uint64)))[0]
    found = sorted(np.concatenate(seen["x"]).tolist())
    assert found == sorted([end] * 3 + vocabulary.inputs(np.r_[1:10, 20:23]).tolist())
    assert sum(seen["fresh"]) == 3 + 1 + 1


def test_slices_are_tasks_and_equal_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(R, "SLICE_TOKENS", 600)
    monkeypatch.setattr(R, "FOLD", 2)
    seen, trained, stored = [], R._trained, R.stored

    def kept(samples, slices, vocabulary):
        seen.append((samples.groupBy("slice", "turn").count().collect(), slices))
        return trained(samples, slices, vocabulary)

    def noted(df, purpose):
        made = stored(df, purpose)
        if purpose == "weights":
            seen.append(made.agg({"n": "sum"}).first()[0])
        return made

    monkeypatch.setattr(R, "_trained", kept)
    monkeypatch.setattr(R, "stored", noted)
    docs = spark.createDataFrame([(None, "a b c d e")] * 600, "doc_id long, text string").repartition(3)
    found = R.language_model_scores(docs).collect()
    assert len(found) == 600 and len({r.score for r in found}) == 1
    groups, slices = seen[0]
    assert slices == 6 and {r["slice"] for r in groups} == set(range(6)) and max(r["count"] for r in groups) < 80
    assert len(seen) == 1 + 3 * 4  # 6 sets, then 3, 2 and 1 of them, in each round
    assert all(len(set(seen[i:i + 4])) == 1 for i in range(1, 13, 4)) and sum(seen[1:13:4]) == 600 * 6


def test_vocabulary_finds_all_and_no_others():
    rng = np.random.default_rng(5)
    words = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    v = R.Vocabulary(words, rng.integers(1, 9, len(words)), 10**6, len(words))
    assert np.array_equal(v.words[v.find(words)], words)
    assert (v.find(words + np.uint64(1)) == len(words)).sum() >= len(words) - 1


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(i, f"w{i} x") for i in range(200)], "doc_id long, text string").filter(R.held_out())
    found = R.language_model_scores(docs).collect()
    assert found and all(r.n_known == 0 and r.train_tokens == 0 and abs(r.base_score) < 1e-9 and r.score < 1e-3 for r in found)
    assert R.language_model_scores(docs.limit(0)).count() == 0
