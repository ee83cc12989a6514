"""BPE automaton and token-count transducers against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunedata.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = " \n\t  aabsetrvmld'1290,.!=-é 中\U0001f600́\u0085  \x1c"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(7)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    out += ["".join(chr(rng.choice([rng.randint(0, 0x2FFF), rng.randint(0, 255), rng.randint(0x10000, 0x323AF), 32]))
                    for _ in range(30)) for _ in range(4000)]
    return out + ["", "a<|endoftext|> b<|endoftext|><|endof", "   ", "'re'll've'r", "x" * 3000, "=" * 5000, "ab" * 2000,
                  " 's", "\n's", "''s", "a  's", "'r", "'", "it'S we'LL"]


def test_encode_and_decode_like_the_library(library, strings):
    coder = bpe.Encoder(*bpe.compiled(PATH))
    for s in strings:
        want = library.encode(s, add_special_tokens=False).ids
        packed = coder.encode(s)
        assert np.frombuffer(packed, "<u4").tolist() == want, s
        assert coder.decode(packed) == library.decode(want, skip_special_tokens=False)


def test_decode_of_single_tokens(library):
    coder = bpe.Encoder(*bpe.compiled(PATH))
    for i in range(0, 50257, 97):
        assert coder.decode(np.array([i], "<u4").tobytes()) == library.decode([i], skip_special_tokens=False)


def test_paths_of_a_small_automaton_are_the_merge_results():
    alphabet = {b: c for c, b in bpe.byte_alphabet().items()}
    merges = [["a", "b"], ["b", "a"], ["a", "a"], ["ab", "a"], ["aa", "b"], ["aba", "b"], ["b", "b"]]
    vocab = {alphabet[b]: b for b in range(256)}
    for m in merges:
        vocab.setdefault("".join(m), len(vocab))
    import json
    a = bpe.Automaton(json.dumps({"model": {"vocab": vocab, "merges": merges}, "added_tokens": []}))
    for n in range(1, 9):
        for bits in range(1 << n):
            word = "".join("ab"[bits >> i & 1] for i in range(n))
            parts = list(word)
            for x, y in merges:  # one rule after the other, each from left to right
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == x and parts[i + 1] == y:
                        parts[i:i + 2] = [x + y]
                    i += 1
            assert [a.labels[t].decode() for t in a.encode_bytes(word.encode())] == parts
            assert token_counts.WordTransducer(a).count(word.encode()) == len(parts)


def test_counts_like_the_library(library, strings):
    counter = token_counts.Counter(*bpe.compiled(PATH))
    for n in range(0, len(strings), 500):
        part = strings[n:n + 500]
        assert counter.count(part) == [len(e.ids) for e in library.encode_batch(part, add_special_tokens=False)]
    assert counter.count([]) == []


def test_entry_states_do_not_depend_on_the_chunks(monkeypatch):
    rng = np.random.default_rng(3)
    classes = rng.integers(0, 11, 5000).astype(np.uint8)
    whole = token_counts.word_starts(classes)
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    assert (token_counts.word_starts(classes) == whole).all()


def test_small_caches_forget_and_find_again(library, strings, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    monkeypatch.setattr(bpe, "CACHE_ARCS", 5)
    monkeypatch.setattr(token_counts, "CACHE_STATES", 5)
    coder, counter = bpe.Encoder(*bpe.compiled(PATH)), token_counts.Counter(*bpe.compiled(PATH))
    for s in strings[:300]:
        want = library.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(s), "<u4").tolist() == want and counter.count([s]) == [len(want)]


def test_tables_with_odd_rows(spark, library, odd_documents, no_documents):
    texts = sorted((r["text"] or "") for r in odd_documents.collect())
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = bpe.encode_decode(odd_documents, PATH, with_ids=True).collect()
    want = sorted((len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(t.encode()).hexdigest(), i) for t, i in zip(texts, ids))
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"]) for r in got) == want
    got = token_counts.count_tokens(odd_documents, PATH).collect()
    want = sorted((len(t.encode()), len(i), len(i) > 1024) for t, i in zip(texts, ids))
    assert sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want
    assert bpe.encode_decode(no_documents, PATH).count() == token_counts.count_tokens(no_documents, PATH).count() == 0
