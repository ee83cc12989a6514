import random
import re

from tunedata.operators import encode, vocab


def _brute_encode(text, table, unk=0):
    """Plain restatement: highest-scoring adjacent join, leftmost on ties."""
    pieces = {t: s for t, (i, s, k) in table.items() if k == "normal"}
    ids = {t: i for t, (i, s, k) in table.items() if k != "special"}
    out = []
    for w in [w for w in re.split(r"[\t\n\x0b\f\r ]+", text) if w]:
        syms = ["▁"] + list(w)
        while True:
            cands = [(pieces[a + b], -i) for i, (a, b) in enumerate(zip(syms, syms[1:])) if a + b in pieces]
            if not cands:
                break
            _, neg = max(cands)
            i = -neg
            syms[i:i + 2] = [syms[i] + syms[i + 1]]
        out.extend(ids.get(s, unk) for s in syms)
    return out


def test_piece_encoder_matches_brute_force(spark):
    corpus = spark.createDataFrame([(t,) for t in ["low lower lowest", "newer wider new", "lowlow"]],
                                   "value string")
    v = vocab.bpe_vocab(corpus, n_merges=8)
    table = {r.token: (r.id, r.score, r.kind) for r in v.collect()}
    assert sorted(r[0] for r in table.values()) == list(range(len(table)))
    texts = ["lower newest", "", "  low  ", "zzz low", "lowlowlow wid"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {r.k: r.ids for r in encode.encode_pieces(docs, "k", "text", v).collect()}
    assert got == {i: _brute_encode(t, table) for i, t in enumerate(texts)}
    dec = {r.k: r.text for r in encode.decode_ids(
        spark.createDataFrame(list(got.items()), "k long, ids array<int>"), "k", "ids", v).collect()}
    assert dec[0] == "lower newest" and dec[2] == "low" and dec[1] == ""


def test_user_symbols_are_atomic(spark):
    corpus = spark.createDataFrame([("ab ab ab",)], "value string")
    v = vocab.bpe_vocab(corpus, n_merges=2)
    ids = {r.token: r.id for r in v.collect()}
    docs = spark.createDataFrame([(1, "ab<sepra>ab"), (2, "<sepra>")], "k long, text string")
    got = {r.k: r.ids for r in encode.encode_pieces(docs, "k", "text", v).collect()}
    # merges learned: (a, b) (ties with (▁, a), 'a' sorts first), then (▁, ab);
    # the "ab" after the symbol has no word mark
    assert got[1] == [ids["▁ab"], ids["<sepra>"], ids["ab"]]
    assert got[2] == [ids["▁"], ids["<sepra>"]]


def test_symbols_are_cut_before_words(spark):
    rows = [(0, "<unk>", 0.0, "special"), (1, "a b", 0.0, "user_defined"), (2, "▁", -3.0, "normal"),
            (3, "▁x", -1.0, "normal"), (4, "x", -4.0, "normal"), (5, "xx", -0.5, "normal"), (6, "y", -5.0, "normal")]
    v = spark.createDataFrame([(t, i, sc, k) for i, t, sc, k in rows], "token string, id int, score double, kind string")
    texts = {"x": [3], "a b": [2, 1], "xa bx": [3, 1, 4], "x a b xx": [3, 2, 1, 2, 5], "a by a bx": [2, 1, 6, 2, 1, 4],
             "": [], "  ": [], "xxxx": [2, 5, 5], "xxx": [2, 5, 4], "a ba b": [2, 1, 1]}
    docs = spark.createDataFrame([(t, t) for t in texts] + [(None, None)], "k string, text string")
    got = {r.k: r.ids for r in encode.encode_pieces(docs, "k", "text", v).collect()}
    assert got == {**texts, None: []}


def test_long_words_join_like_the_plain_rule():
    rng = random.Random(1)
    scores = {}
    for n in (2, 3, 4):
        for _ in range(30):
            scores["".join(rng.choice("ab▁") for _ in range(n))] = -float(rng.randint(0, 12))
    for _ in range(200):
        word = ["▁"] + [rng.choice("ab") for _ in range(rng.randint(0, 30))]
        syms = list(word)
        while True:
            cands = [(scores[a + b], -i) for i, (a, b) in enumerate(zip(syms, syms[1:])) if a + b in scores]
            if not cands:
                break
            i = -max(cands)[1]
            syms[i:i + 2] = [syms[i] + syms[i + 1]]
        assert encode._joined(word, scores) == syms
    assert len(encode._joined(["a"] * 20_000, {"a" * n: -float(n) for n in (2, 4, 8)})) == 2500
