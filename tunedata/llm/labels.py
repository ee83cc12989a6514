"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import text_or_empty
from tunedata.session import materialize


def fold(parts: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids have none."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, usable: Column, per_class: int,
                    max_bytes: int = 64 << 20) -> DataFrame:
    """``doc_id, text, label`` of at most ``per_class`` documents of each class and ``max_bytes`` of text.

    Ids are drawn by hash among the labels (a top-k, so reruns agree), before
    any text is read; the texts come by a join with that bounded list, one row an
    id: of repeated ids the smallest text, and the smallest label. Texts that would
    take the sample beyond ``max_bytes``, in the order of their hash, are left out. Rows
    whose label is neither 0 nor 1 or whose id is null are not used.
    """
    ids = (labels.filter(usable & F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
           .groupBy("doc_id").agg(F.min(target).alias("label")))
    drawn = [ids.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    texts = (docs.select("doc_id", text_or_empty().alias("text"))
             .join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")
             .groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    # At most 2 * per_class rows from here on.
    texts = materialize(texts.withColumn("bytes", F.octet_length("text").cast("bigint")), how="table")
    so_far = F.sum("bytes").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    fits = texts.select("doc_id", "bytes").withColumn("so_far", so_far).filter(F.col("so_far") <= max_bytes)
    return texts.join(F.broadcast(fits.select("doc_id")), "doc_id").select("doc_id", "text", "label")
