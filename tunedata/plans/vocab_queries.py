"""Registered queries of production-size and lossless vocabularies, beside those of ``catalog``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.functions.codec import WORD_MARK
from tunedata.operators import pieces, reports, unigram, vocab
from tunedata.plans.catalog import (FAMILY_ENCODERS, PIECE_CHARS, PIECE_MERGES, SQL_WORD_VOCAB, VOCAB_SIZE, _array_sum,
                                    _big, _documents_corpus, _fixed_piece_vocab, _vocab_out, _word_vocab_docs, oracle_sql,
                                    register)
from tunedata.session import materialize, scratch_path
from tunedata.sources import model_files, tables

UNIGRAM_SIZE = 4000
# Byte pieces follow the small subword vocabulary: 4 fixed pieces, 11 merges, 29 characters.
FIRST_BYTE = 4 + len(PIECE_MERGES) + len(PIECE_CHARS)


def _encoded(spark, sf, v: DataFrame, model_type: str) -> DataFrame:
    """Every document's token counts and whether its text comes back whole."""
    docs = tables.table(spark, sf, "documents", spread=True).select("doc_id", "text")
    v = materialize(v)
    ids = pieces.text_ids(docs.select(F.struct("doc_id", "text").alias("key"), "text"), "key", "text", v, model_type)
    back = pieces.decode_texts(ids.select(F.struct("key", "ids").alias("key"), "ids"), "key", "ids", v)
    first = F.lit(v.filter(F.col("kind") == "byte").agg(F.min("id")).first()[0])
    return back.select(_big("key.key.doc_id").alias("doc_id"), F.size("key.ids").cast("bigint").alias("n_tokens"),
                       F.size(F.filter("key.ids", lambda i: i >= first)).cast("bigint").alias("n_bytes"),
                       F.size(F.filter("key.ids", lambda i: i == vocab.UNK_ID)).cast("bigint").alias("n_unk"),
                       (F.coalesce("key.key.text", F.lit("")) == F.col("text")).cast("bigint").alias("roundtrip_ok"))


@register("bpe_30k_encode")
def q_bpe_30k_encode(spark, sf):
    """V1 at the default size: 30,000 pieces (256 of them bytes) learned from all documents, which are
    then encoded and decoded with them."""
    v = vocab.bpe_vocab(_documents_corpus(spark, sf), VOCAB_SIZE - 256)
    return _encoded(spark, sf, pieces.with_byte_pieces(v), "bpe")


@register("unigram_encode")
def q_unigram_encode(spark, sf):
    """V1 with ``model_type=unigram``: pieces by EM over all documents, then best paths and back."""
    v = unigram.unigram_vocab(_documents_corpus(spark, sf), UNIGRAM_SIZE - 256, seed_size=4 * UNIGRAM_SIZE)
    return _encoded(spark, sf, pieces.with_byte_pieces(v), "unigram")


def sql_byte_pieces(table: str, key: str) -> str:
    """``t(<key>, n, bytes, ids)``: pieces, byte pieces and the sum of ids of each whole text by the small
    vocabulary with bytes. A literal mark is set aside as chr(4), which no text holds."""
    sym = (f"chr(1) || array_to_string(list_concat(['{WORD_MARK}'], string_split(replace(replace(text, '{WORD_MARK}', chr(4)), "
           f"' ', '{WORD_MARK}'), '')), chr(2) || chr(1)) || chr(2)")
    for a, b in PIECE_MERGES:
        sym = f"replace({sym}, chr(1) || '{a}' || chr(2) || chr(1) || '{b}' || chr(2), chr(1) || '{a}{b}' || chr(2))"
    ids = ", ".join(f"('{t}', {i + 4})" for i, t in enumerate([a + b for a, b in PIECE_MERGES] + list(PIECE_CHARS)))
    return f"""
sy AS (SELECT {key}, {sym} AS sym FROM {table} WHERE text <> ''),
sp AS (SELECT {key}, replace(unnest(string_split(sym[2:len(sym) - 1], chr(2) || chr(1))), chr(4), '{WORD_MARK}') AS piece,
              unnest(string_split(sym[2:len(sym) - 1], chr(2) || chr(1))) = chr(4) AS literal FROM sy),
pc AS (SELECT {key}, CASE WHEN literal THEN NULL ELSE id END AS id, hex(encode(sp.piece)) AS raw
       FROM sp LEFT JOIN (VALUES {ids}) v(piece, id) USING (piece)),
t AS (SELECT {key}, sum(CASE WHEN id IS NULL THEN len(raw) // 2 ELSE 1 END) AS n,
             sum(CASE WHEN id IS NULL THEN len(raw) // 2 ELSE 0 END) AS bytes,
             sum(CASE WHEN id IS NULL THEN list_sum([('0x' || raw[2 * i - 1:2 * i])::INT + {FIRST_BYTE}
                                                     FOR i IN range(1, len(raw) // 2 + 1)]) ELSE id END) AS ids
      FROM pc GROUP BY {key})"""


def _byte_piece_vocab(spark) -> DataFrame:
    return pieces.with_byte_pieces(_fixed_piece_vocab(spark))


SQL_BYTE_ENCODING = f"""
WITH {sql_byte_pieces('documents', 'doc_id')}
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_tokens,
       CAST(coalesce(bytes, 0) AS BIGINT) AS n_bytes, CAST(coalesce(ids, 0) AS BIGINT) AS id_sum
FROM documents LEFT JOIN t USING (doc_id)"""


def _byte_encoding(spark, sf, **options) -> DataFrame:
    docs = tables.table(spark, sf, "documents", spread=True).select("doc_id", "text")
    ids = pieces.text_ids(docs, "doc_id", "text", _byte_piece_vocab(spark), **options)
    return ids.select(_big("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
                      F.size(F.filter("ids", lambda i: i >= FIRST_BYTE)).cast("bigint").alias("n_bytes"),
                      _array_sum(F.col("ids")).alias("id_sum"))


@register("encode_bytes", SQL_BYTE_ENCODING)
def q_encode_bytes(spark, sf):
    """V6 with byte fallback: whole texts, white space kept, bytes for what the vocabulary lacks."""
    return _byte_encoding(spark, sf)


@register("encode_bytes_joined", SQL_BYTE_ENCODING)
def q_encode_bytes_joined(spark, sf):
    """The same with the vocabulary as a table, as beyond the broadcast bound."""
    return _byte_encoding(spark, sf, max_bytes=0)


@register("model_lengths_bytes", oracle_sql()["model_lengths"].replace("'piece'", "'bytes'").replace(
    "sum(coalesce(n, 0)), count(*) FILTER (text = plain AND coalesce(n_unk, 0) = 0)\n      FROM flat LEFT JOIN unk USING (item_id)",
    f"(WITH {sql_byte_pieces('(SELECT item_id, text FROM benchmark)', 'item_id')} SELECT sum(n) FROM t), count(*) FROM flat"))
def q_model_lengths_bytes(spark, sf):
    """``model_lengths`` with byte fallback for the llama family: every text comes back."""
    b = tables.table(spark, sf, "benchmark").select("text")
    word = materialize(vocab.word_vocab(b.select(F.col("text").alias("value")), vocab_size=VOCAB_SIZE))
    r = reports.model_lengths(b, encoders={**FAMILY_ENCODERS, "llama": "bytes"},
                              vocabularies={"word": word, "bytes": _byte_piece_vocab(spark)})
    return r.select("model_name", _big("bos_id"), _big("eos_id"), _big("pad_id"), _big("n_texts"),
                    _big("n_chars"), _big("n_tokens"), _big("n_roundtrip"))


@register("model_file_roundtrip", f"""
WITH {SQL_WORD_VOCAB}
SELECT token, CAST(id AS BIGINT) AS id, CAST(score AS BIGINT) AS score, kind FROM v""")
def q_model_file_roundtrip(spark, sf):
    """K4/K5 then S7 in the binary format: the word vocabulary as one ``.model`` file and back."""
    path = scratch_path(spark, "vocab") + ".model"
    model_files.write_model(_word_vocab_docs(spark, sf), path)
    return _vocab_out(model_files.read_model(spark, path))
