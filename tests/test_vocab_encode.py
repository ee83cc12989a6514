import collections
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tunedata.functions.codec import codepoints, codepoints_decode, words
from tunedata.operators import encode, reports, vocab


def _vocab(spark, tokens, scores=None):
    rows = [(t, i, float(scores[i]) if scores else float(-i), "normal") for i, t in enumerate(tokens)]
    return spark.createDataFrame(rows, vocab.VOCAB_SCHEMA)


def _sources(spark, lists):
    rows = [(t, o, s + 1) for s, lst in enumerate(lists) for o, t in enumerate(lst)]
    return spark.createDataFrame(rows, "token string, ord int, source int")


def test_merge_vocabs_golden(spark):
    base = _vocab(spark, ["a", "b"], scores=[-1.5, -2.5])
    m = vocab.merge_vocabs(base, _sources(spark, [["b", "c"], ["c", "d"]]))
    got = {r.token: (r.id, r.score, r.source) for r in m.collect()}
    assert got == {"a": (0, -1.5, 0), "b": (1, -2.5, 0), "c": (2, 0.0, 1), "d": (3, 0.0, 2)}


def test_merge_drops_duplicates_inside_a_source(spark):
    base = _vocab(spark, ["a"])
    m = vocab.merge_vocabs(base, _sources(spark, [["x", "y", "x"], ["y", "z"]]))
    got = sorted((r.id, r.token) for r in m.collect())
    assert got == [(0, "a"), (1, "x"), (2, "y"), (3, "z")]
    rep = {r.source: (r.n_pieces, r.n_added) for r in
           vocab.merge_report(base, _sources(spark, [["x", "y", "x"], ["y", "z"]]), m).collect()}
    assert rep == {0: (1, 1), 1: (3, 2), 2: (2, 1)}


def test_coverage_exact_boundary(spark):
    counts = spark.createDataFrame([("a", 9000), ("b", 995), ("c", 4), ("d", 1)], "ch string, n long")
    got = {r.ch: r.kept for r in vocab.char_coverage(counts, 0.9995).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False}


def test_bpe_pair_counts_and_first_merge(spark):
    corpus = spark.createDataFrame([("aaa ab ab",)], "value string")
    pc = {(r.a, r.b): r.n for r in vocab.pair_counts(vocab.bpe_words(corpus)).collect()}
    assert pc == {("▁", "a"): 3, ("a", "a"): 2, ("a", "b"): 2}
    m = vocab.bpe_merges(corpus, 3)
    assert [(r.a, r.b, r.n) for r in m.orderBy("rank").collect()][0] == ("▁", "a", 3)


def _greedy(texts, n_merges):
    wc = collections.Counter(w for t in texts for w in re.split(r"[\t\n\x0b\f\r ]+", t) if w)
    words = {tuple(["▁"] + list(w)): n for w, n in wc.items()}
    out = []
    for r in range(n_merges):
        pc = collections.Counter()
        for sym, n in words.items():
            for x, y in zip(sym, sym[1:]):
                pc[(x, y)] += n
        if not pc:
            break
        (a, b), n = min(pc.items(), key=lambda kv: (-kv[1], kv[0]))
        out.append((r, a, b, n))
        nxt = collections.Counter()
        for sym, c in words.items():
            res, i = [], 0
            while i < len(sym):
                if i + 1 < len(sym) and (sym[i], sym[i + 1]) == (a, b):
                    res.append(a + b)
                    i += 2
                else:
                    res.append(sym[i])
                    i += 1
            nxt[tuple(res)] += c
        words = nxt
    return out


def test_bpe_matches_greedy(spark):
    texts = ["the cat sat on the mat", "aaaa aaa aa a", "a$b a$b \\x \\x", "thethe the the"]
    corpus = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [tuple(r) for r in vocab.bpe_merges(corpus, 12).orderBy("rank").collect()]
    assert got == _greedy(texts, 12)
    v = vocab.bpe_vocab(corpus, n_merges=5)
    ids = sorted(r.id for r in v.collect())
    assert ids == list(range(len(ids)))


def test_word_and_char_vocab_ids_dense(spark):
    corpus = spark.createDataFrame([("b a a c c c",), ("  c  ",)], "value string")
    wv = sorted((r.id, r.token) for r in vocab.word_vocab(corpus, vocab_size=6).collect())
    assert wv == [(0, "<unk>"), (1, "<s>"), (2, "</s>"), (3, "<sepra>"), (4, "▁c"), (5, "▁a")]
    cv = sorted((r.id, r.token) for r in vocab.char_vocab(corpus).collect())
    assert [t for _, t in cv][4:] == ["c", "a", "b"] and [i for i, _ in cv] == list(range(7))


def test_word_encode_decode(spark):
    corpus = spark.createDataFrame([("the cat",), ("the dog",)], "value string")
    v = vocab.word_vocab(corpus)
    docs = spark.createDataFrame([(1, "the cat zebra"), (2, ""), (3, "  dog   the ")], "k long, text string")
    enc = {r.k: r.ids for r in encode.encode_words(docs, "k", "text", v).collect()}
    ids = {r.token: r.id for r in v.collect()}
    assert enc == {1: [ids["▁the"], ids["▁cat"], vocab.UNK_ID], 2: [], 3: [ids["▁dog"], ids["▁the"]]}
    ids_df = spark.createDataFrame(list(enc.items()), "k long, ids array<int>")
    dec = {r.k: r.text for r in encode.decode_ids(ids_df, "k", "ids", v).collect()}
    assert dec == {1: "the cat", 2: "", 3: "dog the"}
    # a vocabulary too large to send: the join plan
    far = {r.k: r.ids for r in encode.encode_words(docs, "k", "text", v, max_bytes=10).collect()}
    assert far == enc
    far = {r.k: r.text for r in encode.decode_ids(ids_df, "k", "ids", v, max_bytes=10).collect()}
    assert far == dec
    near, far = ({r.k: r.ids for r in encode.encode_pieces(docs, "k", "text", v, max_bytes=m).collect()} for m in (1 << 20, 10))
    assert far == near


def test_codepoints_edge_cases(spark):
    df = spark.createDataFrame([("",), ("a😀b",), ("é",)], "t string")
    got = [r[0] for r in df.select(codepoints("t")).collect()]
    assert got == [[], [97, 128512, 98], [233]]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=20), min_size=1, max_size=8))
def test_codepoint_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", codepoints("t").alias("ids"), codepoints_decode(codepoints("t")).alias("back")).collect()
    for r in out:
        assert r.ids == [ord(c) for c in r.t] and r.back == r.t


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abc ", min_size=1, max_size=14), min_size=1, max_size=6),
       st.integers(1, 15))
def test_bpe_batch_rule_equals_greedy(spark, texts, n):
    corpus = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [tuple(r) for r in vocab.bpe_merges(corpus, n).orderBy("rank").collect()]
    assert got == _greedy(texts, n)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab c", min_size=1, max_size=14), min_size=1, max_size=6),
       st.integers(1, 12))
def test_bpe_with_few_candidates_equals_greedy(spark, texts, n):
    corpus = spark.createDataFrame([(t,) for t in texts], "value string")
    want = _greedy(texts, n)
    got = vocab.bpe_merges_by_rounds(corpus, n, compact_every=1, candidates=2).orderBy("rank").collect()
    assert [tuple(r) for r in got] == want
    got = vocab.bpe_merges(corpus, n, ladder=((1, 0), (2, 1))).orderBy("rank").collect()
    assert [tuple(r) for r in got] == want


def test_special_tokens_report(spark):
    corpus = spark.createDataFrame([("a b",)], "value string")
    got = sorted((r.id, r.token, r.kind) for r in vocab.special_tokens(vocab.word_vocab(corpus)).collect())
    assert got == [(0, "<unk>", "special"), (1, "<s>", "special"), (2, "</s>", "special"),
                   (3, "<sepra>", "user_defined")]


def test_encoders_and_merge_ignore_partitioning(spark):
    corpus = spark.createDataFrame([(f"w{i % 7} w{i % 3} x{i}",) for i in range(60)], "value string")
    v = vocab.word_vocab(corpus, vocab_size=12)
    docs = corpus.withColumn("k", F.monotonically_increasing_id()).select("k", F.col("value").alias("text"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    a = {r.k: r.ids for r in encode.encode_words(docs, "k", "text", v).collect()}
    b = {r.k: r.ids for r in encode.encode_words(docs.repartition(7), "k", "text", v).collect()}
    assert a == b
    bv = vocab.bpe_vocab(corpus, n_merges=4)
    c = {r.k: r.ids for r in encode.encode_pieces(docs, "k", "text", bv).collect()}
    d = {r.k: r.ids for r in encode.encode_pieces(docs.repartition(5), "k", "text", bv).collect()}
    assert c == d
    src = spark.createDataFrame([(t, o, 1 + o % 2) for o, t in enumerate(["p", "q", "w1", "r", "s"])],
                                "token string, ord int, source int")
    m1 = sorted((r.token, r.id) for r in vocab.merge_vocabs(v, src).collect())
    m2 = sorted((r.token, r.id) for r in vocab.merge_vocabs(v.repartition(3), src.repartition(4)).collect())
    assert m1 == m2


def test_bpe_vocabulary_holds_every_covered_character(spark):
    texts = ["the cat wl the mat <s> a|b c|d", "thethe wl\u0085 x  the<sepra>cat <sepra> mat", "wl wl the"]
    corpus = spark.createDataFrame([(t,) for t in texts], "value string")
    symbols = ("<sepra>", "|")
    v = vocab.bpe_vocab(corpus, 50, coverage=1.0, user_symbols=symbols)
    rows = v.collect()
    tokens = [r.token for r in rows]
    assert len(set(tokens)) == len(tokens) <= 50 and sorted(r.id for r in rows) == list(range(len(rows)))
    chars = {c for t in texts for c in t.replace("<sepra>", "").replace("|", "") if c not in " \t\n"}
    assert chars | {"▁"} <= set(tokens)
    assert not any("|" in t and t != "|" for t in tokens) and not any("sepra" in t and t != "<sepra>" for t in tokens)
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    ids = {r.k: r.ids for r in encode.encode_pieces(docs, "k", "text", v).collect()}
    assert all(vocab.UNK_ID not in i for i in ids.values())
    with pytest.raises(ValueError, match="too small"):
        vocab.bpe_vocab(corpus, 10, user_symbols=symbols)


def test_merges_end_at_the_end_of_the_word_only(spark):
    texts = ["ab\u0085 ab  ab ab", "xb  ab\u0085"]
    corpus = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [tuple(r) for r in vocab.bpe_merges(corpus, 6).orderBy("rank").collect()]
    assert got == _greedy(texts, 6)
    w = spark.createDataFrame([("a \u0085",)], "value string").select(words("value")).first()[0]
    assert w == ["a", "\u0085"]


def test_group_vocabularies_by_split_top_k(spark):
    rows = [("x", " ".join(f"w{i % 13}" for i in range(n))) for n in range(1, 60)] + [("y", "only here")]
    corpus = spark.createDataFrame(rows, "lang string, value string")
    by = vocab.word_vocabs_by(corpus, "lang", vocab_size=9)
    for lang in ("x", "y"):
        want = vocab.word_vocab(corpus.filter(F.col("lang") == lang), vocab_size=9)
        assert sorted(map(tuple, by.filter(F.col("lang") == lang).drop("lang").collect())) == sorted(map(tuple, want.collect()))
    plan = by._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4  # both levels, before and behind their exchange


@pytest.mark.parametrize("max_bytes", [encode.MAX_DICTIONARY_BYTES, 0])
def test_repeated_keys_and_texts_stay_rows(spark, max_bytes):
    corpus = spark.createDataFrame([("a b c a",)], "value string")
    v = vocab.word_vocab(corpus)
    rows = [("k", "a b"), ("k", "c"), ("k", "a b"), (None, "a"), (None, None), ("k", None), ("k", "")]
    docs = spark.createDataFrame(rows, "k string, text string")
    ids = {r.token: r.id for r in v.collect()}
    want = [(k, [ids["▁" + w] for w in (t or "").split()]) for k, t in rows]
    enc = encode.encode_words(docs, "k", "text", v, max_bytes=max_bytes)
    assert sorted(((r.k, r.ids) for r in enc.collect()), key=str) == sorted(want, key=str)
    dec = encode.decode_ids(enc, "k", "ids", v, max_bytes=max_bytes)
    assert sorted(((r.k, r.text) for r in dec.collect()), key=str) == sorted(((k, t or "") for k, t in rows), key=str)


@pytest.mark.parametrize("joined", [False, True])
def test_totals_count_repeated_texts(spark, monkeypatch, joined):
    v = vocab.word_vocab(spark.createDataFrame([("a b c a",)], "value string"))
    if joined:
        monkeypatch.setattr(encode, "dictionary", lambda *_: None)
    texts = spark.createDataFrame([("a b",), ("a b",), ("c",)], "text string")
    got = reports.encoder_totals(texts, "text", "word", "word", v).first()
    assert got.asDict() == {"encoder": "word", "n_texts": 3, "n_chars": 7, "n_tokens": 5, "n_roundtrip": 3}
