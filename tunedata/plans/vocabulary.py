"""Vocabulary plans: train one from a text corpus, merge several into a base."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunedata.operators import pieces, unigram, vocab
from tunedata.session import materialize
from tunedata.sources import model_files, readers, sinks


def train(spark: SparkSession, corpus_name_or_path: str, output_path: str, model_name: str = "tokenizer",
          vocab_size: int = vocab.DEFAULT_VOCAB_SIZE, character_coverage: float = vocab.DEFAULT_COVERAGE,
          model_type: str = "bpe", user_defined_symbols: str = ",".join(vocab.DEFAULT_USER_SYMBOLS),
          overwrite: bool = False, byte_fallback: bool = False) -> DataFrame:
    """S6 -> V1/V2/V3 -> K5 (``<out>/<name>.vocab`` as TSV, ``<name>.parquet``, and ``<name>.model``).

    With ``byte_fallback`` (subword models) 256 of the pieces are bytes, behind the others."""
    corpus = readers.read_corpus(spark, corpus_name_or_path)
    symbols = tuple(s for s in user_defined_symbols.split(",") if s)
    if byte_fallback and model_type not in ("bpe", "unigram"):
        raise ValueError(f"byte_fallback is for subword models (got {model_type!r})")
    learned = vocab_size - 256 if byte_fallback else vocab_size
    if model_type == "bpe":
        v = vocab.bpe_vocab(corpus, learned, coverage=character_coverage, user_symbols=symbols)
    elif model_type == "unigram":
        v = unigram.unigram_vocab(corpus, learned, coverage=character_coverage, user_symbols=symbols)
    elif model_type == "word":
        v = vocab.word_vocab(corpus, vocab_size=vocab_size, user_symbols=symbols)
    elif model_type == "char":
        v = vocab.char_vocab(corpus, vocab_size=vocab_size, coverage=character_coverage,
                             user_symbols=symbols)
    else:
        raise ValueError(f"model_type must be bpe, unigram, word or char (got {model_type!r})")
    v = materialize(pieces.with_byte_pieces(v) if byte_fallback else v)
    sinks.write_vocab(v, f"{output_path}/{model_name}.parquet", overwrite=overwrite)
    sinks.write_vocab(v, f"{output_path}/{model_name}.vocab", tsv=True, overwrite=overwrite)
    model_files.write_model(v, f"{output_path}/{model_name}.model", overwrite=overwrite, model_type=model_type)
    return v


def _base(spark: SparkSession, path: str, base_symbols) -> DataFrame:
    if path.rstrip("/").endswith(".model"):
        return model_files.read_model(spark, path).select("token", "id", "score", "kind")
    return readers.read_vocab_tsv(spark, path, glob=None).select(
        "token", F.col("ord").alias("id"), "score",
        F.when(F.col("token").isin(list(vocab.SPECIAL_PIECES)), "special")
        .when(F.col("token").isin(list(base_symbols)), "user_defined").otherwise("normal").alias("kind"))


def merge(spark: SparkSession, base_vocab: str, sources_path: str, output_dir: str,
          overwrite: bool = False, base_symbols=vocab.DEFAULT_USER_SYMBOLS,
          suffix: str = ".vocab") -> tuple[DataFrame, DataFrame]:
    """S7 -> V4 -> K4, with the V5 report. ``sources_path`` is one vocabulary
    or several, comma separated, or a folder: then its entries that end with
    ``suffix``, and nothing else. Sources are numbered by path (D14). The base
    keeps its kinds: special pieces, ``base_symbols`` as user-defined, the rest normal.

    Vocabularies whose names end with ``.model`` are read in that format. A base of that
    format keeps all of its kinds, and ``merged.model`` takes over its settings.
    """
    base = _base(spark, base_vocab, base_symbols)
    paths = sorted(q for p in sources_path.split(",") if p for q in readers.vocab_paths(spark, p, suffix))
    models = [p for p in paths if p.rstrip("/").endswith(".model")]
    lines = [p for p in paths if p not in models]
    src = readers.read_vocab_tsv(spark, lines, glob=None).select("token", "ord", "file") if lines else None
    if models:
        read = model_files.read_model(spark, models).select("token", F.col("id").alias("ord"), "file")
        src = read if src is None else src.unionByName(read)
    files = src.select("file").distinct()
    files = files.withColumn("source", F.dense_rank().over(Window.orderBy("file")))  # one row per file
    sources = src.join(F.broadcast(files), "file").select("token", "ord", "source")
    merged = materialize(vocab.merge_vocabs(base, sources))  # written in three forms
    sinks.write_vocab(merged, f"{output_dir}/merged.parquet", overwrite=overwrite)
    sinks.write_vocab(merged, f"{output_dir}/merged.vocab", tsv=True, overwrite=overwrite)
    like = base_vocab if base_vocab.rstrip("/").endswith(".model") else None
    model_files.write_model(merged, f"{output_dir}/merged.model", like=like, overwrite=overwrite)
    return merged, vocab.merge_report(base, sources, merged)
