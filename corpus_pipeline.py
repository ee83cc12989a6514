"""The corpus pipeline: stages applied to ``documents`` one after the other.

Every stage works on all that the stage before kept and returns the columns of
``documents``, but for the last, which returns the encoded corpus. The
classifier of the first stage is fitted on the labels of ``sf_dir``, the chain of
the third on the documents it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunedata.llm import bpe, mixing, pii, quality, simhash
from tunedata.llm.common import read
from tunedata.llm.queries import tokenizer_path
from tunedata.session import scratch_path

QUALITY_THRESHOLD = 0.3
SHINGLE_WORDS, MAX_BITS = 4, 4


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    chain = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score_documents(docs, chain, QUALITY_THRESHOLD, keep=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=SHINGLE_WORDS, max_bits=MAX_BITS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind."""
    return pii.mask_documents(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: a row per document and pass that takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus as token ids, with the digests of the round trip."""
    return bpe.encode_decode(docs, tokenizer_path(), with_ids=True)


STAGES = [("quality classifier", keep_quality), ("SimHash near-dedup", drop_near_duplicates),
          ("PII", mask_personal_data), ("mixing sources", mix_sources), ("BPE encoding and decoding", encode)]

# The fitted models, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
