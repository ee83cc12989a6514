"""Reports over tokenized data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.functions.codec import codepoints, codepoints_decode, words
from tunedata.operators import encode, pieces
from tunedata.operators.profiles import profiles_df, tokenizer_kind
from tunedata.operators.vocab import UNK_ID

# Encoder used for each tokenizer family. Only the code-point encoder needs no
# vocabulary, so every family maps to it unless the caller passes a mapping.
DEFAULT_ENCODERS = {"llama": "codepoint", "glm": "codepoint", "bloom": "codepoint",
                    "pythia": "codepoint", "baichuan": "codepoint", "auto": "codepoint"}


def encoder_totals(texts: DataFrame, text_col: str, name: str, kind: str, vocabulary: DataFrame | None) -> DataFrame:
    """One row for an encoder: ``encoder, n_texts, n_chars, n_tokens, n_roundtrip``."""
    x = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if kind == "codepoint":
        ids = codepoints(F.col("text"))
        x = x.select("text", F.size(ids).alias("_tokens"), codepoints_decode(ids).alias("_back"))
    elif kind in ("word", "piece"):
        if vocabulary is None:
            raise ValueError(f"encoder {name!r} needs a vocabulary")
        enc = encode.encode_words if kind == "word" else encode.encode_pieces
        ids = enc(x.withColumn("_key", F.col("text")), "_key", "text", vocabulary)
        back = encode.decode_ids(ids.select("ids", F.struct(F.col("_key").alias("text"), F.size("ids").alias("n"))
                                            .alias("_key")), "_key", "ids", vocabulary)
        x = back.select("_key.text", F.col("_key.n").alias("_tokens"), F.col("text").alias("_back"))
    elif kind == "bytes":
        if vocabulary is None:
            raise ValueError(f"encoder {name!r} needs a vocabulary")
        ids = pieces.text_ids(x.withColumn("_key", F.col("text")), "_key", "text", vocabulary)
        back = pieces.decode_texts(ids.select("ids", F.struct(F.col("_key").alias("text"), F.size("ids").alias("n"))
                                              .alias("_key")), "_key", "ids", vocabulary)
        x = back.select("_key.text", F.col("_key.n").alias("_tokens"), F.col("text").alias("_back"))
    else:
        raise ValueError(f"unknown encoder {kind!r}; known: codepoint, word, piece, bytes")
    return x.agg(F.count(F.lit(1)).alias("n_texts"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"),
                 F.coalesce(F.sum("_tokens"), F.lit(0)).alias("n_tokens"),
                 F.coalesce(F.sum((F.col("_back") == F.col("text")).cast("int")), F.lit(0)).alias("n_roundtrip")
                 ).select(F.lit(name).alias("encoder"), "*")


def model_lengths(texts: DataFrame, text_col: str = "text", encoders: dict | None = None,
                  vocabularies: dict[str, DataFrame] | None = None) -> DataFrame:
    """V8 / J6 / A4 per model: special ids, texts, characters, tokens, round trips.

    ``encoders`` maps each tokenizer family to ``codepoint``, ``word``, ``piece`` or ``bytes``
    (pieces with byte fallback, lossless); all but the first read ``vocabularies[<that name>]``. Texts are encoded once per
    encoder, not once per model: the per-encoder totals (one row per encoder) are
    joined to the small profile table, which keeps every model. A family or
    encoder without a definition is an error.
    """
    enc = encoders or DEFAULT_ENCODERS
    families = set(DEFAULT_ENCODERS) - set(enc)
    if families:
        raise ValueError(f"no encoder for the families {sorted(families)}")
    totals = None
    for kind in sorted(set(enc.values())):
        one = encoder_totals(texts, text_col, kind, kind, (vocabularies or {}).get(kind))
        totals = one if totals is None else totals.unionByName(one)
    kind = tokenizer_kind(F.col("model_type"))
    mapping = F.create_map(*[x for k, v in enc.items() for x in (F.lit(k), F.lit(v))])
    prof = profiles_df(texts.sparkSession).withColumn("encoder", F.element_at(mapping, kind))
    return prof.join(F.broadcast(totals), "encoder", "left")


def vocab_comparison(texts: DataFrame, by: str, text_col: str, vocabs: dict[str, list]) -> DataFrame:
    """A5: per group of ``by`` the words and, for each named dictionary, the unknown ones
    (``n_tokens, unk_<name>``); groups without words are left out. Texts are encoded
    row by row, and only counts are shuffled."""
    ids = texts.select(by, text_col)
    for name, rows in vocabs.items():
        ids = encode.word_ids(ids, text_col, rows, f"_{name}")
    first = f"_{next(iter(vocabs))}"
    return ids.groupBy(by).agg(
        F.sum(F.size(first)).cast("bigint").alias("n_tokens"),
        *[F.sum(F.size(F.filter(f"_{name}", lambda i: i == UNK_ID))).cast("bigint").alias(f"unk_{name}")
          for name in vocabs]).filter("n_tokens > 0")


def split_counts(df: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    """Rows and characters per split (or source)."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"),
                              F.sum(F.length(text_col)).alias("n_chars"))


def corpus_union(parts: dict[str, DataFrame], text_col: str = "value") -> DataFrame:
    """Union several corpora (``origin`` = part name) and report rows, characters, words."""
    frames = [df.select(F.lit(name).alias("origin"), F.col(text_col).alias("value"))
              for name, df in parts.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("origin").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum(F.length("value")).alias("n_chars"),
                                   F.sum(F.size(words(F.col("value")))).alias("n_words"))


def file_counts(corpus: DataFrame) -> DataFrame:
    """A6 for a file corpus: rows per input file (``_metadata.file_name``)."""
    return corpus.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"))
