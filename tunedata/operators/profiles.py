"""Model profiles: special token ids per model (J1, J2) and the encoder registry.

The tables are data, shipped as literal rows and joined with ``broadcast``
(14 built-in rows plus any the caller adds; fixed size).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.functions.text import last_path_segment

# Special ids the training path overrides per model name
# (name, bos_id, eos_id, pad_id); the model type is our own grouping. More
# models are passed as ``extra`` rows of the same shape.
SPECIAL_IDS = [
    ("open_llama_7b", "llama", 1, 2, 0),
    ("open_llama_13b", "llama", 1, 2, 0),
    ("chinese-alpaca-13b", "llama", 1, 2, 49953),
    ("chatglm2-6b", "glm", None, 2, 0),
    ("baichuan-7B", "baichuan", 1, 2, 0),
    ("Baichuan-13B-Base", "baichuan", 1, 2, 0),
    ("Baichuan-13B-Chat", "baichuan", 1, 2, 0),
    ("bloomz-7b1", "bloom", 1, 2, 3),
    ("bloomz-1b7", "bloom", 1, 2, 3),
    ("tigerbot-7b-sft", "bloom", 1, 2, 3),
    ("tigerbot-7b-base", "bloom", 1, 2, 3),
    ("pythia-12b-deduped", "pythia", 0, 0, 1),
    ("pythia-12b-sft-v8-7k-steps", "pythia", 0, 0, 1),
    ("pythia-1b-deduped", "pythia", 0, 0, 1),
]

# Ids the tokenizers report on their own (name, bos_id, eos_id, pad_id).
NATIVE_IDS = [
    ("open_llama_13b", 1, 2, None),
    ("open_llama_7b", 1, 2, None),
    ("Chinese-LLaMA-7B", 1, 2, None),
    ("chinese-alpaca-13b", 1, 2, 49953),
    ("tigerbot-7b-sft", 1, 2, 3),
    ("tigerbot-7b-base", 1, 2, 3),
    ("chatglm2-6b", None, 2, 0),
    ("pythia-12b-deduped", 0, 0, None),
    ("pythia-12b-sft-v8-7k-steps", 0, 0, 1),
    ("pythia-1b-deduped", 0, 0, None),
    ("Baichuan-13B-Base", 1, 2, 0),
    ("Baichuan-13B-Chat", 1, 2, 0),
    ("baichuan-7B", 1, 2, None),
    ("bloomz-7b1", 1, 2, 3),
    ("bloomz-1b7", 1, 2, 3),
]

# Model types with a tokenizer of their own; any other type
# falls back to the automatic one. Model type whose native ids win.
TOKENIZER_TYPES = ("llama", "glm", "bloom", "pythia", "baichuan")
NATIVE_TYPE = "glm"

PROFILE_SCHEMA = "model_name string, model_type string, bos_id int, eos_id int, pad_id int"
NATIVE_SCHEMA = "model_name string, bos_id int, eos_id int, pad_id int"


@dataclass(frozen=True)
class Profile:
    model_name: str
    model_type: str
    bos_id: int | None
    eos_id: int
    pad_id: int | None

    @property
    def bos_or_zero(self) -> int:
        """F-null-1: a missing bos id is written as 0 in the pair layout."""
        return 0 if self.bos_id is None else self.bos_id


def profiles_df(spark: SparkSession, extra=()) -> DataFrame:
    """The profile dimension table: built-in rows plus caller-supplied ``extra``
    rows ``(model_name, model_type, bos_id, eos_id, pad_id)``."""
    return spark.createDataFrame(list(SPECIAL_IDS) + list(extra), PROFILE_SCHEMA)


def native_ids_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NATIVE_IDS, NATIVE_SCHEMA)


def model_key(path: str) -> str:
    """Last path segment, trailing slashes ignored."""
    return path.rstrip("/").split("/")[-1]


def resolve_profile(model_name_or_path: str, model_type: str,
                    native: tuple[int | None, int, int | None] | None = None, extra=()) -> Profile:
    """J1 on the driver for a single run's parameters (small fixed lookup).

    ``glm`` keeps the tokenizer's own ids (``native``, else the recorded ones);
    every other type must be in the table, a miss names the model.
    """
    key = model_key(model_name_or_path)
    if model_type == NATIVE_TYPE:
        if native is None:
            rec = {n: (b, e, p) for n, b, e, p in NATIVE_IDS}.get(key)
            if rec is None:
                raise ValueError(f"no native special ids known for model {key!r}")
            native = rec
        b, e, p = native
        return Profile(key, model_type, b, e, p)
    table = {n: (t, b, e, p) for n, t, b, e, p in list(SPECIAL_IDS) + list(extra)}
    if key not in table:
        raise ValueError(f"model {key!r} has no special-id profile")
    _, b, e, p = table[key]
    return Profile(key, model_type, b, e, p)


def attach_special_ids(df: DataFrame, path_col: str, type_col: str, extra=()) -> DataFrame:
    """J1/J2 as a join: bos/eos/pad per row from the model path and type.

    Native ids win for ``glm``; a name missing from the table fails the job with
    an error naming it (``raise_error``), as the reference's KeyError does.
    """
    spark = df.sparkSession
    prof = profiles_df(spark, extra).select(
        "model_name", *[F.col(c).alias("t_" + c) for c in ("bos_id", "eos_id", "pad_id")],
        F.lit(True).alias("_in_table"))
    nat = native_ids_df(spark).select(
        "model_name", *[F.col(c).alias("n_" + c) for c in ("bos_id", "eos_id", "pad_id")])
    out = (df.withColumn("model_name", last_path_segment(path_col))
           .join(F.broadcast(prof), "model_name", "left")
           .join(F.broadcast(nat), "model_name", "left"))
    native = F.col(type_col) == F.lit(NATIVE_TYPE)
    missing = F.raise_error(F.concat(F.lit("model has no special-id profile: "), F.col("model_name")))
    for c in ("bos_id", "eos_id", "pad_id"):
        out = out.withColumn(c, F.when(native, F.col("n_" + c))
                             .when(F.col("_in_table"), F.col("t_" + c))
                             .otherwise(missing.cast("int")))
    return out.drop(*[p + c for p in ("t_", "n_") for c in ("bos_id", "eos_id", "pad_id")], "_in_table")


def native_vs_table(spark: SparkSession) -> DataFrame:
    """J2 report: models whose recorded native ids differ from the table (NULL-safe)."""
    t = profiles_df(spark).alias("t")
    n = native_ids_df(spark).alias("n")
    j = t.join(n, "model_name", "inner")
    differs = ~(F.col("t.bos_id").eqNullSafe(F.col("n.bos_id"))
                & F.col("t.eos_id").eqNullSafe(F.col("n.eos_id"))
                & F.col("t.pad_id").eqNullSafe(F.col("n.pad_id")))
    return j.filter(differs).select(
        "model_name",
        F.col("n.bos_id").alias("native_bos_id"), F.col("n.eos_id").alias("native_eos_id"),
        F.col("n.pad_id").alias("native_pad_id"),
        F.col("t.bos_id").alias("bos_id"), F.col("t.eos_id").alias("eos_id"),
        F.col("t.pad_id").alias("pad_id"))


def tokenizer_kind(model_type: Column) -> Column:
    """Tokenizer family by model type, ``auto`` for unknown types."""
    return F.when(model_type.isin(list(TOKENIZER_TYPES)), model_type).otherwise(F.lit("auto"))
