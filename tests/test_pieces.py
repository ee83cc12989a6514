import itertools
import random

import pytest

from tunedata.functions.codec import WORD_MARK
from tunedata.operators import encode, pieces, reports, vocab

TEXTS = ["the cat sat", "  two  spaces ", "new\nline\ttab\r\n", "", None, "ünïcode 中文 😀", f"a literal {WORD_MARK} mark",
         WORD_MARK, " ", "<sepra>the<sepra> cat<sepra>", "\x00\x04￿", "the cat sat", "thethethe" * 50]


def table(spark, tokens, scores=None, byte=True, symbols=("<sepra>",)):
    rows = [(t, 3 + len(symbols) + i, float(-i if scores is None else scores[i]), "normal") for i, t in enumerate(tokens)]
    v = vocab.fixed_pieces(spark, symbols).unionByName(spark.createDataFrame(rows, vocab.VOCAB_SCHEMA))
    return pieces.with_byte_pieces(v) if byte else v


MERGED = ["th", "the", WORD_MARK + "the", "at", "cat", "sa", "sat", WORD_MARK, "t", "h", "e", "c", "a", "s"]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "k long, text string")


@pytest.mark.parametrize("model_type", ["bpe", "unigram"])
@pytest.mark.parametrize("max_bytes", [pieces.MAX_BROADCAST_BYTES, 0])
def test_round_trip_loses_nothing(spark, model_type, max_bytes):
    v = table(spark, MERGED)
    ids = pieces.text_ids(frame(spark), "k", "text", v, model_type, max_bytes=max_bytes)
    assert all(vocab.UNK_ID not in r["ids"] for r in ids.collect())
    back = {r["k"]: r["text"] for r in pieces.decode_texts(ids, "k", "ids", v, max_bytes=max_bytes).collect()}
    assert back == {k: t or "" for k, t in enumerate(TEXTS)}


@pytest.mark.parametrize("model_type", ["bpe", "unigram"])
@pytest.mark.parametrize("inside", [False, True])
def test_joined_form_equals_broadcast_form(spark, model_type, inside):
    """Also for repeated keys and rows, without byte pieces, and for pieces with marks inside."""
    tokens = [*MERGED, f"t{WORD_MARK}", WORD_MARK * 2] if inside else MERGED
    v = table(spark, tokens, byte=inside)
    rows = [*enumerate(TEXTS), (None, "the cat"), (0, "the cat"), (0, "the cat"), (None, None)]
    docs = spark.createDataFrame(rows, "k long, text string").repartition(3)
    one, two = (sorted(((r["k"], r["ids"]) for r in pieces.text_ids(docs, "k", "text", v, model_type, max_bytes=m).collect()),
                       key=str) for m in (1 << 20, 0))
    assert one == two and len(one) == len(rows)


def test_words_and_bytes_by_hand(spark):
    v = table(spark, MERGED)
    ids = {t: i for t, i in v.select("token", "id").collect()}
    got = {r["k"]: r["ids"] for r in pieces.text_ids(frame(spark, ["theé", " cat", "<sepra>"]), "k", "text", v).collect()}
    assert got[0] == [ids[WORD_MARK + "the"], ids["<0xC3>"], ids["<0xA9>"]]
    assert got[1] == [ids[WORD_MARK], ids[WORD_MARK], ids["cat"]]
    assert got[2] == [ids[WORD_MARK], ids["<sepra>"]]


def test_unknown_characters_without_byte_pieces(spark):
    v = table(spark, MERGED, byte=False)
    got = pieces.text_ids(frame(spark, ["xé"]), "k", "text", v).first()["ids"]
    assert got.count(vocab.UNK_ID) == 2


def test_invalid_byte_runs(spark):
    """Bytes are joined over pieces; each byte of no whole character gives one replacement character."""
    v = table(spark, MERGED)
    ids = {t: i for t, i in v.select("token", "id").collect()}

    def run(*raw):
        return [ids[pieces.byte_piece(b)] for b in raw]

    rows = [(0, run(0xE4, 0xB8, 0xAD)), (1, run(0xE4, 0xB8)), (2, run(0xFF, 0x41, 0xC3)), (3, [*run(0xC3), ids["cat"], *run(0xA9)]),
            (4, [ids["<s>"], *run(0x20), 999_999, ids["cat"]]), (5, None), (6, []), (7, run(0x80) * 3)]
    out = pieces.decode_texts(spark.createDataFrame(rows, "k long, ids array<int>"), "k", "ids", v)
    bad = "�"
    assert {r["k"]: r["text"] for r in out.collect()} == {
        0: "中", 1: bad * 2, 2: bad + "A" + bad, 3: bad + "cat" + bad, 4: " cat", 5: "", 6: "", 7: bad * 3}


def test_some_byte_pieces_are_an_error(spark):
    v = table(spark, MERGED).filter("token <> '<0x41>'")
    with pytest.raises(ValueError, match="256"):
        pieces.text_ids(frame(spark), "k", "text", v)


def test_best_path_against_enumeration():
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        parts = {word[i:j] for i in range(len(word)) for j in range(i + 1, len(word) + 1)}
        scores = {p: -float(rng.randint(1, 6)) for p in rng.sample(sorted(parts), max(1, len(parts) // 2))}
        ways = []
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
            path = [word[a:b] for a, b in zip([0, *ends], ends)]
            if all(p in scores or len(p) == 1 for p in path):
                total = 0.0
                for p in path:
                    total += scores.get(p, -20.0)
                ways.append((-total, [len(p) for p in path[::-1]], path))
        assert pieces.best_path(word, scores, 9, -20.0) == min(ways)[2]


def test_totals_with_byte_fallback(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = reports.encoder_totals(texts, "text", "llama", "bytes", table(spark, MERGED)).first()
    assert got["n_roundtrip"] == got["n_texts"] == len(TEXTS)
    plain = reports.encoder_totals(texts, "text", "llama", "piece", table(spark, MERGED, byte=False)).first()
    assert plain["n_roundtrip"] < plain["n_texts"]


def test_learned_pieces_agree_with_the_word_encoder(spark):
    """On texts of single spaces and covered characters both encoders give the same ids."""
    texts = ["the cat sat on the mat", "that cat", "a hat <sepra> the hat"]
    v = vocab.bpe_vocab(spark.createDataFrame([(t,) for t in texts], "value string"), n_merges=12, coverage=1.0)
    a = pieces.text_ids(frame(spark, texts[:2]), "k", "text", v).orderBy("k").collect()
    b = encode.encode_pieces(frame(spark, texts[:2]), "k", "text", v).orderBy("k").collect()
    assert a == b


def test_word_pieces_beyond_the_bound(spark):
    """``encode_pieces`` gives the same ids with its vocabulary broadcast and as a table."""
    texts = ["the cat sat on the mat", "that  cat\n", "a hat <sepra> the<sepra>hat", "", None, " \t", "<sepra>", f"é {WORD_MARK}the",
             "the cat sat on the mat"]
    v = vocab.bpe_vocab(spark.createDataFrame([(t,) for t in texts[:2]], "value string"), n_merges=12, coverage=1.0)
    docs = spark.createDataFrame([*enumerate(texts), (0, "the cat"), (0, "the cat")], "k long, text string")
    one, two = (sorted(((r["k"], r["ids"]) for r in encode.encode_pieces(docs, "k", "text", v, max_bytes=m).collect()))
                for m in (1 << 20, 0))
    assert one == two and len(one) == len(texts) + 2
