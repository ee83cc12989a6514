"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.session import ship_package

# The word of every contract: a run of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"

# Rows handed to a Python worker at a time: a batch of whole texts must fit in
# its memory, also where some of them are very long.
BATCH_ROWS = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Ship the package and bound the Arrow batches for Python stages."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that no column of ``df`` has (case ignored), one per wanted name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
