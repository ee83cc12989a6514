import itertools
import math
import random

import numpy as np
import pytest

from tunedata.functions.codec import WORD_MARK
from tunedata.operators import pieces, unigram, vocab


def segmentations(word, known):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        path = [word[a:b] for a, b in zip([0, *ends], ends)]
        if all(p in known for p in path):
            yield path


@pytest.fixture(scope="module")
def fitted():
    rng = random.Random(4)
    words = {"".join(rng.choices("abcd", k=rng.randint(1, 7))): rng.randint(1, 9) for _ in range(60)}
    parts = sorted({w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, min(len(w), i + 4) + 1)})
    names = [*"abcd", *rng.sample([p for p in parts if len(p) > 1], 40)]
    value = np.array([rng.random() + 0.1 for _ in names])
    return words, unigram.Model(names, np.log(value / value.sum()))


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)


def test_expected_counts_by_enumeration(spark, fitted):
    words, model = fitted
    logp = dict(zip(model.pieces, model.logp.tolist()))
    want, likelihood = dict.fromkeys(model.pieces, 0.0), 0.0
    for w, n in words.items():
        paths = [(math.exp(sum(logp[p] for p in path)), path) for path in segmentations(w, logp)]
        z = sum(p for p, _ in paths)
        likelihood += n * math.log(z)
        for p, path in paths:
            for piece in path:
                want[piece] += n * p / z
    got, total = unigram.expectation(frame(spark, words), model)
    assert np.allclose(got / unigram.UNIT, list(want.values()), atol=1e-3)
    assert abs(total - likelihood) < 1


def test_best_counts_and_replacement_costs_by_enumeration(spark, fitted):
    words, model = fitted
    logp = dict(zip(model.pieces, model.logp.tolist()))

    def best(word, known):
        return min((-sum(logp[p] for p in path), [len(p) for p in path[::-1]], path) for path in segmentations(word, known))

    want = dict.fromkeys(model.pieces, 0)
    for w, n in words.items():
        for piece in best(w, logp)[2]:
            want[piece] += n
    assert unigram.best_counts(frame(spark, words), model).tolist() == list(want.values())
    cost = unigram.replacement_costs(spark, model)
    for i, piece in enumerate(model.pieces):
        if len(piece) > 1:
            assert cost[i] == pytest.approx(logp[piece] + best(piece, logp.keys() - {piece})[0])


def test_em_does_not_lose_likelihood(spark, fitted):
    """Plain maximum likelihood steps never lower the likelihood; the posterior mean keeps every character."""
    words, model = fitted
    rows, before = frame(spark, words), -math.inf
    now = unigram.Model(model.pieces, model.logp[:-2])
    for _ in range(4):
        counts, likelihood = unigram.expectation(rows, now)
        assert likelihood >= before - 1
        before = likelihood
        p = np.maximum(counts / unigram.UNIT, 1e-9)
        now = unigram.Model(now.pieces, np.log(p / p.sum()))
    small = unigram.maximised(model, unigram.expectation(rows, model)[0], 4)
    assert small.pieces[:4] == list("abcd")


def test_lattice_equals_the_encoder_and_unknown_characters(fitted):
    """The trainer's best paths are those of the encoder, also through characters without a piece."""
    _, model = fitted
    scores = dict(zip(model.pieces, model.logp.tolist()))
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdxé", k=rng.randint(0, 12))) for _ in range(200)] + ["", "abcd" * 60]
    total, paths = unigram.Lattice(model, words).best(model.logp)
    for word, score, path in zip(words, total.tolist(), paths, strict=True):
        want = pieces.best_path(word, scores, model.longest, model.logp[model.unknown])
        assert [len(model.pieces[i]) if i < len(model.pieces) else 1 for i in path] == [len(p) for p in want]
        assert math.isfinite(score)


def test_digamma():
    assert unigram.digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-10)
    x = np.array([0.5, 1.5, 3.0, 10.0, 1e6])
    assert np.allclose(unigram.digamma(x + 1), unigram.digamma(x) + 1 / x, atol=1e-10)


def test_seeds_by_count_and_length(spark):
    words = {WORD_MARK + "abab": 2, WORD_MARK + "ab": 1, "cab": 1}
    model = unigram.seeds(frame(spark, words), ["a", "b", WORD_MARK], 3)
    counts = {}
    for w, n in words.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                counts[w[i:j]] = counts.get(w[i:j], 0) + n
    ranked = sorted((-n * len(p), p) for p, n in counts.items() if n > 1)
    assert model.pieces[3:] == [p for _, p in ranked[:3]]


def test_vocabulary_of_the_asked_size_whatever_the_splits(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 5))) for _ in range(40)]
    texts = [" ".join(rng.choice(stems) + rng.choice(["", "ing", "ed"]) for _ in range(40)) for _ in range(30)]
    corpus = spark.createDataFrame([(t,) for t in texts], "value string")
    one = unigram.unigram_vocab(corpus.repartition(1), 80).orderBy("id").collect()
    two = unigram.unigram_vocab(corpus.repartition(5), 80).orderBy("id").collect()
    assert [r["token"] for r in one] == [r["token"] for r in two]
    assert len(one) == 80 and [r["id"] for r in one] == list(range(80))
    scores = [r["score"] for r in one if r["kind"] == "normal"]
    assert scores == sorted(scores, reverse=True)
    assert {c for t in texts for c in t if c != " "} | {WORD_MARK} <= {r["token"] for r in one}
    v = spark.createDataFrame(one)
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    ids = pieces.text_ids(docs, "k", "text", v, "unigram")
    back = {r["k"]: r["text"] for r in pieces.decode_texts(ids, "k", "ids", v).collect()}
    assert back == dict(enumerate(texts))
    n = sum(len(r["ids"]) for r in ids.collect())
    assert n < 2.2 * sum(len(t.split()) for t in texts)  # far fewer than characters
    with pytest.raises(ValueError, match="too small"):
        unigram.unigram_vocab(corpus, 5)


def test_empty_corpus(spark):
    corpus = spark.createDataFrame([], "value string")
    assert [r["kind"] for r in unigram.unigram_vocab(corpus, 50).collect()] == ["special"] * 3 + ["user_defined"]


def test_user_symbols_are_no_part_of_pieces(spark):
    corpus = spark.createDataFrame([("ab<sepra>ab ab <sepra>ab",)], "value string")
    v = [r["token"] for r in unigram.unigram_vocab(corpus, 20).collect()]
    assert not any("sepra" in t and t != "<sepra>" for t in v) and vocab.DEFAULT_USER_SYMBOLS[0] in v
