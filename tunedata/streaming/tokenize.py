"""Tokenize examples as they arrive (Structured Streaming).

The pair layout (L2) and the per-record chat layout are stateless column
expressions, so a streaming JSON source feeds them directly; the sink is
parquet with a checkpoint location in the shared checkpoint folder, so a
restarted query resumes exactly where it stopped. Rows that fail to parse or
lack a text are written to a separate quarantine sink instead of failing the
stream (D6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tunedata.operators.layouts import chat_layout_records, pair_layout
from tunedata.operators.profiles import Profile
from tunedata.sources.readers import CHAT_SCHEMA, CORRUPT, PROMPT_SCHEMA, _with_corrupt
from tunedata.session import scratch_path


def read_json_stream(spark: SparkSession, source_dir: str, schema: StructType,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(_with_corrupt(schema))
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(source_dir)


def _start(df: DataFrame, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def tokenize_stream(spark: SparkSession, source_dir: str, sink_dir: str, profile: Profile,
                    layout: str = "pair", prompt_column: str = "input", response_column: str = "target",
                    source_len: int = 1024, target_len: int = 128, max_len: int = 512,
                    human_roles=("human",), quarantine_dir: str | None = None,
                    checkpoint_location: str | None = None,
                    available_now: bool = True) -> list[StreamingQuery]:
    """Start the tokenizing stream (and its quarantine stream); returns the queries."""
    ckpt = checkpoint_location or scratch_path(spark, "tokenize-stream")
    if layout == "pair":
        src = read_json_stream(spark, source_dir, PROMPT_SCHEMA)
        bad = F.col(CORRUPT).isNotNull() | F.col(prompt_column).isNull() | F.col(response_column).isNull()
        good = src.filter(~bad).select("sample_id", F.col(prompt_column).alias("prompt"),
                                       F.col(response_column).alias("response"))
        out = pair_layout(good, source_len, target_len, profile.bos_id, profile.eos_id,
                          profile.pad_id, keep=["sample_id"])
    elif layout == "chat":
        src = read_json_stream(spark, source_dir, CHAT_SCHEMA)
        bad = F.col(CORRUPT).isNotNull() | F.exists(
            F.coalesce("conversations", F.array()), lambda t: t["value"].isNull())
        out = chat_layout_records(src.filter(~bad), max_len, profile.eos_id, human_roles)
    else:
        raise ValueError(f"layout must be 'pair' or 'chat', got {layout!r}")
    queries = [_start(out, sink_dir, f"{ckpt}/sequences", available_now)]
    if quarantine_dir:
        queries.append(_start(src.filter(bad), quarantine_dir, f"{ckpt}/quarantine", available_now))
    return queries
