"""Adapters from the parquet driver tables to the canonical input shapes.

Only the needed columns are selected so the scans prune to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value of the classification prompt built over ``labels``/``documents``.
QUALITY_INSTRUCTION = "Is this text of good quality?"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one driver table.

    ``spread`` is for text-heavy row work (exploding words or characters):
    when the scan yields fewer splits than the session has cores (e.g. one
    file with one row group), the rows are dealt round-robin over that many
    partitions first. A large input already has enough splits and is left
    alone, so this never adds a shuffle at scale.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        target = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < target:  # a plain scan: planning only, no job
            df = df.repartition(target)
    return df


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``turns(conv_id, turn, role, value)`` from ``conversations``."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("value"))


# Turn numbers below this go into an example id without collision.
MAX_TURN = 1 << 24
# Turn numbers of one split when the next turn of a conversation is looked up.
TURN_SPLIT = 1024


def with_next_turn(turns: DataFrame, *columns: str) -> DataFrame:
    """``next_<c>`` for each of ``columns``: its value in the conversation's next turn, whatever
    its number (null behind the last).

    A conversation is looked at in splits of TURN_SPLIT turn numbers, so a very
    long one does not meet in one task; the last row of a split takes the first
    row of the next split from a table of one row per split.
    """
    x = turns.withColumn("_split", F.floor(F.col("turn") / TURN_SPLIT))
    order = Window.partitionBy("conv_id", "_split").orderBy("turn")
    led = x.withColumn("_next", F.lead(F.struct(*columns)).over(order)).withColumn("_rn", F.row_number().over(order))
    along = Window.partitionBy("conv_id").orderBy("_split")
    borders = (led.filter(F.col("_rn") == 1)
               .select("conv_id", "_split", F.lead(F.struct(*columns)).over(along).alias("_border"))
               .filter(F.col("_border").isNotNull()))
    return (led.join(borders, ["conv_id", "_split"], "left")
            .withColumns({f"next_{c}": F.coalesce(F.col("_next"), F.col("_border"))[c] for c in columns})
            .drop("_split", "_next", "_rn", "_border"))


def example_id():
    turn = F.col("turn")
    return F.when(turn.between(0, MAX_TURN - 1), F.col("conv_id") * MAX_TURN + turn).otherwise(
        F.raise_error(F.lit(f"turn numbers must be in 0..{MAX_TURN - 1}")).cast("bigint"))


def pairs(spark: SparkSession, sf_dir: str, prompt_role: str = "user",
          response_role: str = "assistant") -> DataFrame:
    """Prompt/response examples: a ``user`` turn whose next turn is ``assistant``."""
    c = with_next_turn(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "role", "text")
    return c.filter((F.col("role") == prompt_role) & (F.col("next_role") == response_role)).select(
        example_id().alias("example_id"), F.col("text").alias("prompt"), F.col("next_text").alias("response"),
        "conv_id", "turn")


def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-shaped rows: ``labels`` joined with ``documents``.

    ``instruction`` is an array, ``input`` the document text, ``target`` yes/no.
    Both sides are data tables; Spark picks the join strategy from their size.
    """
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lab.join(doc, "doc_id", "inner").select(
        "doc_id",
        F.array(F.lit(QUALITY_INSTRUCTION)).alias("instruction"),
        F.col("text").alias("input"),
        F.when(F.col("quality") == 1, "yes").otherwise("no").alias("target"))
