"""Texts are encoded and decoded an array at a time, as one by one."""

import random

import pyarrow as pa
import pytest

from tunedata.operators import pieces

MARK = pieces.WORD_MARK


def _vocabulary(rng, alphabet, ties):
    tokens = {(MARK if rng.random() < 0.4 else "") + "".join(rng.choices(alphabet, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 60))}
    return {t: (300 + i, float(-(rng.randint(0, 4) if ties else i))) for i, t in enumerate(sorted(tokens))}


@pytest.mark.parametrize("seed", range(40))
def test_arrays_equal_one_by_one(seed):
    rng = random.Random(seed)
    alphabet, byte = ("abc", "abcdefg")[seed % 2], seed % 3 > 0
    vocabulary = _vocabulary(rng, alphabet, ties=seed % 5 == 0)
    segment = pieces.Segmenter(vocabulary, list(range(10, 266)) if byte else None, 0, "bpe", -5.0)
    symbols = {"<s>": 9}
    cut, literal = pieces.Cutter(list(symbols), False), segment.bytes_of(pieces.MARK_BYTES)

    def ids(text):
        out = []
        for kind, part in cut(text):
            out += segment(part) if kind == cut.WORD else literal if kind == cut.MARK else [symbols[part]]
        return out

    texts = ["".join(rng.choices(alphabet + "   é中𝒳\n", k=rng.randint(0, 40))) for _ in range(40)]
    texts += [None, "", " ", "a<s>b", f"a{MARK}b", "ab" * 100, "x " + "abc" * 50 + " y"]
    rng.shuffle(texts)
    encoder = pieces.TextEncoder(pieces.Joiner(vocabulary, segment), list(symbols), ids)
    encoded = [ids(t) for t in texts]
    assert encoder(pa.array(texts, pa.string())).to_pylist() == encoded
    assert encoder(pa.array(texts, pa.string()).slice(3, 20)).to_pylist() == encoded[3:23]

    rows = [(t, i, "normal") for t, (i, _) in vocabulary.items()] + [("<s>", 9, "user_defined"), ("<unk>", 0, "special")]
    rows += [(pieces.byte_piece(b), 10 + b, "byte") for b in range(256)] if byte else []
    lists = encoded + [rng.choices([*(r[1] for r in rows), 9999, -1], k=rng.randint(0, 12)) for _ in range(60)] + [None, [], [0], [None, 300]]
    one, many = pieces.Decoder(rows), pieces.TextDecoder(rows)
    assert many(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [one(x) for x in lists]
    assert many(pa.array(lists, pa.list_(pa.int32())).slice(5, 30)).to_pylist() == [one(x) for x in lists[5:35]]


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 5)
    vocabulary = {"ab": (3, -1.0), "a": (4, -2.0), "b": (5, -3.0), MARK: (6, -4.0)}
    segment = pieces.Segmenter(vocabulary, None, 0, "bpe", -4.0)
    encoder = pieces.TextEncoder(pieces.Joiner(vocabulary, segment), [], None)
    for i in range(30):
        assert encoder(pa.array([f"{'a' * i} ab", "b" * i + "ab"])).to_pylist() == [
            [6, *[4] * i, 6, 3], [6, *[5] * i, 3]]
        assert len(encoder.known) <= 5 + 3
