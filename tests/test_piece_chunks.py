"""The encoder with the vocabulary as a table works on chunks of texts."""

import random

import pyarrow as pa

from tests.test_pieces import MERGED, frame, table
from tunedata.functions.codec import WORD_MARK
from tunedata.operators import pieces


def test_no_table_has_a_row_for_each_word(spark, monkeypatch):
    """What is kept and shuffled for texts of many words is a row for some texts, not for a word or substring."""
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("thecas é", k=8)) for _ in range(60)) for _ in range(40)]
    v, docs = table(spark, MERGED), frame(spark, texts).repartition(2)
    kept: list = []
    real = pieces.materialize
    monkeypatch.setattr(pieces, "materialize", lambda df, **o: kept.append(real(df, **o)) or kept[-1])
    one = sorted((r["k"], r["ids"]) for r in pieces.text_ids(docs, "k", "text", v, max_bytes=0).collect())
    assert kept and all(df.count() <= len(texts) for df in kept)
    assert one == sorted((r["k"], r["ids"]) for r in pieces.text_ids(docs, "k", "text", v).collect())


def test_substrings_that_may_be_pieces(spark):
    v = table(spark, [*MERGED, "中𝒳"])
    bits = pieces._piece_bits(v)
    words = [WORD_MARK + "the", "cat", "x中𝒳x", "cat"]
    want = {w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)} & {*MERGED, "中𝒳"}
    found = set(pieces._substrings(words, 4, bits))
    assert want <= found  # a hash may let others through, which the join drops
    assert pieces._substrings(words, 1, bits) == sorted(t for t in found if len(t) == 1)
    assert pieces._substrings(words, 4, bits * 0) == []


def test_lists_are_put_together():
    values = pa.array([[1], [], [2, 3], [4, 5, 6]], pa.list_(pa.int32()))
    places = pa.array([[2, 0, 2], [], [1], [3, 0]], pa.list_(pa.int32()))
    assert pieces._taken(values, places).to_pylist() == [[2, 3, 1, 2, 3], [], [], [4, 5, 6, 1]]
    assert pieces._taken(values.slice(1), places.slice(1, 2)).to_pylist() == [[], [2, 3]]
