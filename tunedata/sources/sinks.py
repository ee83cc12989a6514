"""Writers (K1-K6). Part files, no forced single file; ``overwrite`` is explicit (K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS_SCHEMA = ("temperature double, top_k int, top_p double, do_sample boolean, "
                   "num_beams int, repetition_penalty double, max_new_tokens int")
# The prediction settings' defaults.
DEFAULT_SETTINGS = {"temperature": 0.1, "top_k": 40, "top_p": 0.9, "do_sample": True,
                    "num_beams": 1, "repetition_penalty": 1.2, "max_new_tokens": 400}


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def write_predictions(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """K1: JSON lines."""
    df.write.mode(_mode(overwrite)).json(path)


def write_lines(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """K1 for lines that are JSON already (one string column)."""
    df.write.mode(_mode(overwrite)).text(path)


def write_settings(spark: SparkSession, settings: dict, path: str, overwrite: bool = False) -> None:
    """K2: the run's generation settings as a one-row JSON sidecar."""
    row = {**DEFAULT_SETTINGS, **settings}
    spark.createDataFrame([row], SETTINGS_SCHEMA).coalesce(1).write.mode(_mode(overwrite)).json(path)


def write_sequences(df: DataFrame, path: str, partition_by: list[str] | None = None,
                    overwrite: bool = False) -> None:
    """K3: tokenized sequences as parquet, optionally partitioned (e.g. by split)."""
    w = df.write.mode(_mode(overwrite))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_vocab(vocab: DataFrame, path: str, tsv: bool = False, overwrite: bool = False) -> None:
    """K4 / K5: vocabulary as parquet, or as ``piece TAB score`` lines in id order.

    The TSV form is one file (line number = id); a vocabulary is capped by its
    ``vocab_size``, so the single writing task is bounded.
    """
    if not tsv:
        vocab.write.mode(_mode(overwrite)).parquet(path)
        return
    (vocab.orderBy("id").select("token", F.col("score").cast("string").alias("score")).coalesce(1)
     .write.mode(_mode(overwrite)).option("sep", "\t").option("quote", "").option("escape", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "")
     .csv(path))
