import os
import random

import pytest
from pyspark.sql import functions as F

from tunedata.operators import pieces, vocab
from tunedata.plans import vocabulary
from tunedata.sources import model_files

FOLDER = "/opt/tokenizers"
needs_model = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/piece_bpe_32k.model"), reason="vocabulary files not present")
MODEL = f"{FOLDER}/piece_bpe_32k.model"


def library(path):
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=path)


def rows(p):
    kind = ["unused" if p.IsUnused(i) else "special" if p.IsUnknown(i) or p.IsControl(i) else "byte" if p.IsByte(i)
            else "other" for i in range(p.GetPieceSize())]
    return [(p.IdToPiece(i), i, p.GetScore(i), kind[i]) for i in range(p.GetPieceSize())]


@needs_model
def test_round_trip_of_a_given_file(spark, scratch):
    """Read, written and read by the library: same pieces, scores, kinds, settings and ids of texts."""
    v = model_files.read_model(spark, MODEL)
    got = [(r["token"], r["id"], r["score"], r["kind"]) for r in v.orderBy("id").collect()]
    want = rows(library(MODEL))
    assert [(t, i, s, k if k in ("special", "byte") else "other") for t, i, s, k in got] == want
    out = scratch("copy") + ".model"
    os.makedirs(os.path.dirname(out.removeprefix("file:")), exist_ok=True)
    model_files.write_model(v, out, like=MODEL)
    copy = library(out.removeprefix("file:"))
    assert rows(copy) == want
    texts = ["The quick brown fox.", "  naïve café 中文 😀\n", ""]
    assert copy.encode(texts) == library(MODEL).encode(texts)
    with open(MODEL, "rb") as a, open(out.removeprefix("file:"), "rb") as b:
        assert model_files.parse(a.read()) == model_files.parse(b.read())


@needs_model
def test_pieces_of_a_given_file_encode_like_the_library(spark):
    p = library(MODEL)
    v = model_files.read_model(spark, MODEL).drop("type", "file")
    rng = random.Random(3)
    alphabet = "abc deTé中😀\t.,́ " + "the and of ing"
    texts = ["The quick brown fox jumps.", "naïve café", "中文 and 😀!", "one  two", "x" * 300]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(200)]
    # Only texts that the file's own normaliser leaves alone, which is no part of the vocabulary.
    texts = [t for t in texts if p.decode(p.encode(t)) == t]
    assert len(texts) > 20
    got = pieces.text_ids(spark.createDataFrame(list(enumerate(texts)), "k long, text string"), "k", "text", v)
    assert [r["ids"] for r in got.orderBy("k").collect()] == p.encode(texts)


def test_wire_format():
    many = [("a", -1.5, 1), ("é" * 200, 0.0, 4), ("", 3.25, 2), ("<0x00>", 0.0, 6)]
    rest = b"\x12\x02\x08\x01" + b"\x1d\x00\x00\x80?" + b"\x21" + bytes(8)
    assert model_files.parse(model_files.serialize(many, rest)) == (many, rest)
    for cut in (1, 3, 9):
        with pytest.raises(ValueError):
            model_files.parse(model_files.serialize(many)[:-cut])
    with pytest.raises(ValueError, match="wire type"):
        model_files.parse(b"\x0b")


def test_train_and_merge_model_files(spark, scratch):
    """The training job writes a file the library loads; merging keeps the base's kinds, scores and settings."""
    text = scratch("corpus")
    spark.createDataFrame([("the cat sat on the mat " * 3,), ("that cat that mat",)], "value string").write.text(text)
    out = scratch("model")
    v = vocabulary.train(spark, text, out, vocab_size=300, byte_fallback=True)
    assert v.filter("kind = 'byte'").count() == 256
    local = out.removeprefix("file:")
    p = library(f"{local}/tokenizer.model")
    assert rows(p)[0][0] == "<unk>" and p.GetPieceSize() == v.count()
    other = scratch("other")
    vocabulary.train(spark, text, other, model_type="unigram", vocab_size=60)
    merged, report = vocabulary.merge(spark, f"{out}/tokenizer.model", f"{other}/tokenizer.model", scratch("merged"), suffix=".model")
    base, extra = ({r["token"] for r in model_files.read_model(spark, f"{f}/tokenizer.model").collect()} for f in (out, other))
    assert {r["token"] for r in merged.collect()} == base | extra
    assert merged.filter((F.col("kind") == "byte") & (F.col("source") == 0)).count() == 256
    assert {r["source"]: r["n_added"] for r in report.collect()} == {0: len(base), 1: len(extra - base)}


@pytest.mark.parametrize("model_type", ["bpe", "unigram"])
def test_trained_files_encode_in_the_library_as_here(spark, scratch, model_type):
    """The library, with our file, gives our ids and our texts."""
    rng = random.Random(5)
    stems = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(50)]
    lines = [" ".join(rng.choice(stems) + rng.choice(["", "ing", "ed"]) for _ in range(30)) for _ in range(30)]
    text, out = scratch("corpus"), scratch("model")
    spark.createDataFrame([(t,) for t in lines], "value string").write.text(text)
    v = vocabulary.train(spark, text, out, vocab_size=400, byte_fallback=True, model_type=model_type)
    p = library(f"{out.removeprefix('file:')}/tokenizer.model")
    texts = [*lines, "  two  spaces ", "line\nbreak\tand é中😀", "a<sepra>b <sepra>", "xyz abcing", "q" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    ids = pieces.text_ids(df, "k", "text", v, model_type)
    got = [r["ids"] for r in ids.orderBy("k").collect()]
    assert got == p.encode(texts)
    assert [r["text"] for r in pieces.decode_texts(ids, "k", "ids", v).orderBy("k").collect()] == texts == p.decode(got)


def test_ids_must_be_dense(spark, scratch):
    v = spark.createDataFrame([("a", 0, 0.0, "normal"), ("b", 2, 0.0, "normal")], vocab.VOCAB_SCHEMA)
    with pytest.raises(ValueError, match="piece numbers"):
        model_files.write_model(v, scratch("bad") + ".model")
