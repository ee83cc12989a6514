"""Blocks of words: the same merges in few rounds, whatever part of the pairs a round looks at."""

import random

import numpy as np
import pytest

from tests.test_vocab_encode import _greedy
from tunedata.operators import bpe_train, vocab


def _corpus(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)


def test_open_ends_of_runs_do_not_end_a_round():
    """What stands beside a run is no more frequent than the last pair that the round sees."""
    both = bpe_train.OPEN_LEFT | bpe_train.OPEN_RIGHT
    top = [("a", "b", 10), ("c", "d", 9), ("e", "f", 8), ("g", "h", 7)]
    runs = [([a, b], n, both) for a, b, n in top]
    assert bpe_train.greedy(top, False, runs, set(), 100) == top[:3]
    # Of pairs as frequent as the last one, those that a product made here may begin are not certain.
    tied = [("a", "b", 10), ("ab0", "d", 7), ("ab9", "f", 7), ("g", "h", 7)]
    runs = [([a, b], n, both) for a, b, n in tied]
    assert bpe_train.greedy(tied, False, runs, set(), 100) == tied[:1]


def test_runs_are_cut_between_other_pairs(spark):
    df = spark.createDataFrame([("a b c d a b", 3), ("x a b", 2), ("a b", 1)], "sym string, n bigint").coalesce(1)
    names = bpe_train.Names()
    rows = bpe_train.runs_of(bpe_train.packed(df), names, [("a", "b"), ("c", "d")]).collect()
    got = {("".join(names.text(c) for c in np.frombuffer(r["codes"], np.uint32).tolist()), r["ends"]): r["n"] for r in rows}
    left, right = bpe_train.OPEN_LEFT, bpe_train.OPEN_RIGHT
    assert got == {("ab", right): 3, ("cd", left | right): 3, ("ab", left): 5, ("ab", 0): 1}


@pytest.mark.parametrize("k", [1, 2, 5, 40])
def test_ties_at_the_end_of_what_a_round_sees(spark, k):
    """All counts are small, so that most pairs are as frequent as the last one looked at."""
    rng = random.Random(k)
    texts = [" ".join("".join(rng.choices("abc中𝒳", k=rng.randint(1, 6))) for _ in range(3)) for _ in range(6)]
    got = vocab.bpe_merges(_corpus(spark, texts), 25, ladder=((k,),)).orderBy("rank").collect()
    assert [tuple(r) for r in got] == _greedy(texts, 25)


def test_blocks_equal_words_as_text(spark):
    rng = random.Random(5)
    words = {tuple(rng.choices("abcé中𝒳", k=rng.randint(2, 12))): rng.randint(1, 1 << 40) for _ in range(500)}
    df = spark.createDataFrame([(" ".join(w), n) for w, n in words.items()], "sym string, n bigint").repartition(3)
    merges = [("a", "b"), ("ab", "c"), ("c", "c"), ("中", "𝒳"), ("a", "中𝒳"), ("ab", "ab")]
    names = bpe_train.Names()
    for a, b in merges:
        names.add(a + b)
    blocks = bpe_train.after_merges(bpe_train.packed(df), names, merges)
    text = bpe_train.merged(df, merges)
    got = []
    for row in blocks.toArrow().to_batches():
        for block in bpe_train.Block.blocks([row]):
            at = np.split(block.codes, np.cumsum(block.lengths)[:-1])
            got += [(" ".join(map(names.text, w.tolist())), n) for w, n in zip(at, block.counts.tolist(), strict=True)]
    assert sorted(got) == sorted(tuple(r) for r in text.collect())
    want = sorted(((r["a"], r["b"], r["n"]) for r in vocab.pair_counts(text).collect()), key=lambda r: (-r[2], r[0], r[1]))
    assert bpe_train.best_pairs(blocks, names, 10_000) == want
    assert bpe_train.best_pairs(blocks, names, 7) == want[:7]
