import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.test_vocab_encode import _greedy
from tunedata.operators import bpe_train, encode, vocab


@pytest.fixture(scope="module")
def texts():
    """Words with shared stems, runs of one letter and many equal counts."""
    rng = random.Random(8)
    stems = ["".join(rng.choices("abcdeé中", k=rng.randint(1, 6))) for _ in range(60)]
    return [" ".join(rng.choice(stems) + rng.choice(stems) * rng.randint(0, 2) for _ in range(30)) for _ in range(40)]


@pytest.mark.parametrize("options", [{}, {"max_segments": 40}])
def test_merges_equal_greedy(spark, texts, options):
    n = 400 if not options else 60
    corpus = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)
    got = [tuple(r) for r in vocab.bpe_merges(corpus, n, **options).orderBy("rank").collect()]
    assert got == _greedy(texts, n)


def test_rounds_give_the_same_list(spark, texts):
    corpus = spark.createDataFrame([(t,) for t in texts[:10]], "value string")
    by_rounds = vocab.bpe_merges_by_rounds(corpus, 40).orderBy("rank").collect()
    assert by_rounds == vocab.bpe_merges(corpus, 40).orderBy("rank").collect()


def test_all_merges_then_the_end(spark):
    """More merges than there are pairs: the list ends when every word is one piece."""
    corpus = spark.createDataFrame([("ab abc aaaa b",)], "value string")
    got = vocab.bpe_merges(corpus, 10_000).collect()
    assert [tuple(r) for r in sorted(got)] == _greedy(["ab abc aaaa b"], 10_000)
    assert vocab.bpe_merges(corpus.limit(0), 5).count() == 0


def test_pieces_of_a_full_vocabulary_encode_words_whole(spark, texts):
    corpus = spark.createDataFrame([(t,) for t in texts], "value string")
    v = vocab.bpe_vocab(corpus, 30_000, coverage=1.0)
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    ids = {r["k"]: r["ids"] for r in encode.encode_pieces(docs, "k", "text", v).collect()}
    assert {k: len(i) for k, i in ids.items()} == {k: len(t.split()) for k, t in enumerate(texts)}


def _pairs(words):
    out = {}
    for w, n in words:
        for p in zip(w, w[1:]):
            out[p] = out.get(p, 0) + n
    return out


def _cut(word, n, pairs, reach):
    """Segments of a word, position by position, unlike the operator."""
    near = [any(0 <= i + d < len(word) - 1 and (word[i + d], word[i + d + 1]) in pairs for d in range(-reach - 1, reach + 1))
            for i in range(len(word))]
    out, at = [], 0
    while at < len(word):
        if near[at]:
            end = at
            while end < len(word) and near[end]:
                end += 1
            out.append((word[at:end], n, (at > 0) + 2 * (end < len(word))))
            at = end
        else:
            at += 1
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abcd", min_size=2, max_size=12), st.integers(1, 5)), min_size=1, max_size=14),
       st.integers(1, 6), st.integers(0, 3))
def test_a_round_is_a_prefix_of_greedy(words, k, reach):
    """Whatever part of the ranking and of the words a round sees, its merges are those that greedy merging takes."""
    now = [(list(w), n) for w, n in words]
    products: set = set()
    for _ in range(4):
        ranked = sorted(((a, b, n) for (a, b), n in _pairs(now).items()), key=lambda r: (-r[2], r[0], r[1]))
        if not ranked:
            return
        top = ranked[:k]
        segments = [s for w, n in now for s in _cut(w, n, {(a, b) for a, b, _ in top}, reach)]
        found = bpe_train.greedy(top, len(ranked) <= k, segments, products, 100)
        assert found
        for a, b, n in found:
            best = min(_pairs(now).items(), key=lambda kv: (-kv[1], kv[0]))
            assert best == ((a, b), n)
            runs = bpe_train.Words()
            for w, c in now:
                runs.add(w, c)
            runs.merge(a, b)
            now = [([runs.text[s] for s in w], c) for w, c in zip(runs.words, runs.counts, strict=True)]
            products.add(a + b)


def test_segments_and_merges_of_words(spark):
    rng = random.Random(4)
    words = {tuple(rng.choices("abcde", k=rng.randint(2, 14))): rng.randint(1, 9) for _ in range(300)}
    df = spark.createDataFrame([(" ".join(w), n) for w, n in words.items()], "sym string, n bigint").repartition(3)
    pairs = [("a", "b"), ("c", "c"), ("b", "a")]
    for reach in (0, 1, 3):
        want = {}
        for w, n in words.items():
            for seg, c, ends in _cut(list(w), n, set(pairs), reach):
                want[" ".join(seg), ends] = want.get((" ".join(seg), ends), 0) + c
        got = {(r["sym"], r["ends"]): r["n"] for r in bpe_train.segments_of(df, pairs, reach).collect()}
        assert got == want
    after = bpe_train.merged(df, [("a", "b"), ("ab", "c"), ("c", "c")]).collect()
    runs = bpe_train.Words()
    for w, n in words.items():
        runs.add(list(w), n)
    for a, b in [("a", "b"), ("ab", "c"), ("c", "c")]:
        runs.merge(a, b)
    want = sorted((" ".join(runs.text[s] for s in w), n) for w, n in zip(runs.words, runs.counts, strict=True) if len(w) > 1)
    assert sorted(tuple(r) for r in after) == want


def test_pair_counts_of_batches(spark):
    """Counted in the tasks as by native expressions, also where a task gives its counts in parts."""
    rng = random.Random(6)
    words = [(" ".join(rng.choices(["a", "b", "ab", "é", "中文", "𝒳"], k=rng.randint(1, 9))), rng.randint(1, 1 << 40)) for _ in range(900)]
    df = spark.createDataFrame(words, "sym string, n bigint").repartition(3)
    want = sorted(tuple(r) for r in vocab.pair_counts(df).collect())
    assert sorted(tuple(r) for r in bpe_train.pair_counts(df).collect()) == want
    assert bpe_train.pair_counts(df.limit(0)).count() == 0


def test_words_counted_in_tasks(spark):
    """One count of the words gives the words and characters that the texts have."""
    texts = [" a\tb\x0b\x0cc\r\nd ", "a\x1cb a\x85b a\xa0b c", "x<sepra>y <sepra> z", "￿ ￿q<sepra>", "", None, " ", "é中 𝒳 a a"]
    corpus = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)
    for symbols in ((), ("<sepra>",)):
        cut = corpus.withColumn("value", vocab.cut_symbols(corpus["value"], symbols, vocab.CUT))
        assert sorted(vocab.counted_words(corpus, user_symbols=symbols).collect()) == sorted(vocab.word_counts(cut).collect())
        chars = {r["ch"] for r in vocab.char_counts(corpus, user_symbols=symbols).collect()}
        covered = vocab.covered_chars(corpus, coverage=1.0, user_symbols=symbols).collect()
        assert {r["token"] for r in covered} == chars | {vocab.WORD_MARK}
        order = vocab.char_coverage(vocab.char_counts(corpus, user_symbols=symbols)).collect()
        rank = {r["token"]: r["rank"] for r in covered}
        assert sorted(chars, key=rank.get) == [r["ch"] for r in sorted(order, key=lambda r: r["rank"])]
