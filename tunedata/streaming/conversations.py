"""Chat layout (L1) on a stream of turns (Structured Streaming).

Turns of a conversation come in any order and in any batch. They are kept as keyed state until
the conversation is complete: the watermark has passed its newest turn by ``idle``. Then it is
emitted once, as the batch layout would make it from the same turns.

State is bounded for each conversation: every turn has at least one token, so no more than the
``max_len - 1`` turns of smallest number are kept. A turn that is later than the watermark is left
out by Spark; the watermark's delay says how late turns may be.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType

from tunedata.functions.text import DEFAULT_HUMAN_ROLES
from tunedata.operators.layouts import chat_layout_records
from tunedata.session import ship_package

STATE = "turn array<bigint>, role array<string>, value array<string>, newest bigint"


def completed(turns: DataFrame, max_turns: int, delay: str, idle_seconds: int, time_col: str = "ts") -> DataFrame:
    """``conv_id, conversations`` of every complete conversation of the stream ``turns`` (``conv_id, turn, role,
    value`` and the event time ``time_col``); rows without a turn number are left out."""
    ship_package(turns.sparkSession)
    idle = idle_seconds * 1000

    def collect(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            turn, role, value, _ = state.get
            state.remove()
            yield pd.DataFrame({"conv_id": [key[0]], "turn": [list(turn)], "role": [list(role)], "value": [list(value)]})
            return
        turn, role, value, newest = state.get if state.exists else ([], [], [], 0)
        rows = list(zip(turn, role, value, strict=True))
        for f in frames:
            rows += zip(f["turn"].tolist(), f["role"].tolist(), f["value"].tolist(), strict=True)
            newest = max(newest, int(f["ms"].max()))
        rows.sort(key=lambda r: r[0])
        turn, role, value = (list(c) for c in zip(*rows[:max_turns], strict=True))
        state.update((turn, role, value, newest))
        state.setTimeoutTimestamp(max(newest + idle, state.getCurrentWatermarkMs() + 1))

    kind = turns.schema["conv_id"].dataType
    arrays = StructType.fromDDL("turn array<bigint>, role array<string>, value array<string>")
    out = StructType([StructField("conv_id", kind), *arrays.fields])
    rows = (turns.filter(F.col("turn").isNotNull()).withWatermark(time_col, delay)
            .select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "value", time_col,
                    F.unix_millis(time_col).alias("ms")))
    found = rows.groupBy("conv_id").applyInPandasWithState(collect, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    each = F.transform(F.arrays_zip("role", "value"), lambda t: F.struct(t["role"].alias("from"), t["value"].alias("value")))
    return found.select("conv_id", each.alias("conversations"))


def chat_layout_stream(turns: DataFrame, max_len: int, eos_id: int, human_roles: Iterable[str] = DEFAULT_HUMAN_ROLES,
                       delay: str = "10 minutes", idle_seconds: int = 1800, time_col: str = "ts") -> DataFrame:
    """L1 over a stream: ``conv_id, input_ids, attention_mask, labels`` of every complete conversation."""
    whole = completed(turns, max_len - 1, delay, idle_seconds, time_col)
    return chat_layout_records(whole, max_len, eos_id, human_roles, keep=["conv_id"])
