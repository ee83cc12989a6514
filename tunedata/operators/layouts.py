"""Model-ready sequences: pair layout (L2) and chat layout (L1).

Both are column expressions over ``ARRAY<INT>``; the chat layout adds one
shuffle by conversation. Encoding is done by the caller (``encode_fn``), by
default the code-point encoder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunedata.functions.arrays import (IGNORE_INDEX, any_supervised, copy_fallback,
                                       empty_ints, int_array, repeat)
from tunedata.functions.codec import codepoints
from tunedata.functions.text import DEFAULT_HUMAN_ROLES, human_template, is_human

Encoder = Callable[[Column], Column]


def _any_null(cols: Iterable[str]) -> Column:
    bad = None
    for c in cols:
        cond = F.col(c).isNull()
        bad = cond if bad is None else (bad | cond)
    return bad


def invalid_rows(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """D6 quarantine: the input rows a layout with ``on_invalid='quarantine'``
    leaves out (a NULL in one of the text columns), to be written aside."""
    return df.filter(_any_null(list(cols)))


def _check_invalid(df: DataFrame, cols: Iterable[str], on_invalid: str) -> DataFrame:
    """A NULL text fails the job (``fail``, default, as the reference); with
    ``drop`` or ``quarantine`` its row is left out (``invalid_rows`` returns
    the quarantined rows)."""
    cols = list(cols)
    bad = _any_null(cols)
    if on_invalid in ("drop", "quarantine"):
        return df.filter(~bad)
    if on_invalid == "fail":
        message = F.lit("NULL text in column(s) " + ",".join(cols))
        return df.filter(F.when(bad, F.raise_error(message)).otherwise(F.lit(True)))
    raise ValueError(f"on_invalid must be 'fail', 'drop' or 'quarantine', got {on_invalid!r}")


def pair_layout(df: DataFrame, source_len: int, target_len: int, bos_id: int | None,
                eos_id: int, pad_id: int, prompt_col: str = "prompt",
                response_col: str = "response", encode_fn: Encoder = codepoints,
                mask_pad_labels: bool = False, on_invalid: str = "fail",
                keep: Iterable[str] = ()) -> DataFrame:
    """L2: ``a[:S-1] + [eos, bos] + b[:T-2] + [eos]`` right-padded to ``S+T``.

    Labels are IGNORE_INDEX over ``a`` and the first eos, then the ids from the
    bos on - padding included (D3); ``mask_pad_labels`` masks the pad positions.
    No shuffle: every row is independent.
    """
    if source_len < 1 or target_len < 2:
        raise ValueError("source_len must be >= 1 and target_len >= 2")
    total = source_len + target_len
    bos = 0 if bos_id is None else bos_id
    x = _check_invalid(df, [prompt_col, response_col], on_invalid)
    x = x.select(*keep, F.slice(encode_fn(F.col(prompt_col)), 1, source_len - 1).alias("_a"),
                 F.slice(encode_fn(F.col(response_col)), 1, target_len - 2).alias("_b"))
    core = F.concat(F.col("_a"), int_array(eos_id, bos), F.col("_b"), int_array(eos_id))
    x = x.select(*keep, F.size("_a").alias("_na"), core.alias("_core"))
    ids = F.concat(F.col("_core"), repeat(pad_id, F.lit(total) - F.size("_core")))
    x = x.select(*keep, "_na", F.size("_core").alias("_nreal"), ids.alias("input_ids"))
    head = repeat(IGNORE_INDEX, F.col("_na") + 1)
    tail = F.slice(F.col("input_ids"), F.col("_na") + 2, F.lit(total))
    labels = F.concat(head, tail)
    if mask_pad_labels:
        labels = F.transform(labels, lambda v, i: F.when(i >= F.col("_nreal"), F.lit(IGNORE_INDEX))
                             .otherwise(v))
    return x.select(*keep, "input_ids", labels.alias("labels"))


def chat_turn_tokens(turns: DataFrame, max_len: int, eos_id: int,
                     human_roles: Iterable[str] = DEFAULT_HUMAN_ROLES,
                     encode_fn: Encoder = codepoints, on_invalid: str = "fail") -> DataFrame:
    """L1 steps 1-3 and W1 per turn, cut to the first ``max_len - 1`` tokens.

    Input ``(conv_id, turn, role, value)``; a row with NULL ``turn`` stands for
    a conversation without turns (D20). Output per kept turn: ``start`` (token
    offset in the conversation), ``n_tok`` before the cut and the cut
    ``tok_ids`` / ``tok_labels``.

    Every turn has at least one token (the human template is never empty, other
    turns end in eos, and an encoder that gives a template no id is an error), so only the first ``max_len - 1`` turns can start
    before the cut: a ``row_number`` limit that Spark applies per map partition
    before the shuffle (WindowGroupLimit), which bounds what a single huge
    conversation sends to one task.
    """
    limit = max_len - 1
    if limit < 1:
        raise ValueError("max_len must be >= 2")
    empty_conv = F.col("turn").isNull()
    t = turns.select("conv_id", "turn", "role", "value")
    if on_invalid in ("drop", "quarantine"):
        t = t.filter(empty_conv | F.col("value").isNotNull())
    else:
        t = _check_invalid(t.withColumn("_v", F.when(empty_conv, F.lit("")).otherwise(F.col("value"))),
                           ["_v"], on_invalid).drop("_v")
    order = Window.partitionBy("conv_id").orderBy("turn")
    # Limit first, on the raw text: the shuffle moves strings, not int arrays,
    # and the encoder runs on the reduce side for kept turns only.
    t = t.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= limit).drop("_rn")
    human = is_human("role", human_roles)
    t = t.select("conv_id", "turn", (~human).alias("sup"),
                 encode_fn(human_template(F.col("value"), human)).alias("ids"))
    none = ~empty_conv & ~F.col("sup") & (F.size("ids") == 0)
    t = t.withColumn("ids", F.when(none, F.raise_error(F.lit("the encoder gave a human turn no ids")).cast("array<int>"))
                     .otherwise(F.col("ids")))
    t = t.select("conv_id", "turn", "sup",
                 F.when(empty_conv, empty_ints())
                  .when(F.col("sup"), F.concat(F.col("ids"), int_array(eos_id)))
                  .otherwise(F.col("ids")).alias("tok_ids"),
                 F.when(empty_conv, empty_ints())
                  .when(F.col("sup"), F.concat(F.col("ids"), int_array(eos_id)))
                  .otherwise(repeat(IGNORE_INDEX, F.size("ids"))).alias("tok_labels"))
    t = t.withColumn("n_tok", F.size("tok_ids"))
    t = t.withColumn("start", F.coalesce(
        F.sum("n_tok").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    t = t.filter(F.col("start") < limit)
    keep = F.least(F.col("n_tok"), F.lit(limit) - F.col("start"))
    return t.select("conv_id", "turn", "sup", "start", "n_tok",
                    F.slice("tok_ids", 1, keep).alias("tok_ids"),
                    F.slice("tok_labels", 1, keep).alias("tok_labels"))


def chat_layout(turns: DataFrame, max_len: int, eos_id: int,
                human_roles: Iterable[str] = DEFAULT_HUMAN_ROLES,
                encode_fn: Encoder = codepoints, on_invalid: str = "fail") -> DataFrame:
    """L1: one row per conversation with ``input_ids``, ``attention_mask``, ``labels``.

    Turns are concatenated in turn order (A1) after the cut, so a group holds
    at most ``max_len - 1`` tokens. The window and the group-by share the
    ``conv_id`` partitioning: one shuffle in total. Without any supervised
    label, positions 18..23 copy their ids into the labels (step 6).
    """
    t = chat_turn_tokens(turns, max_len, eos_id, human_roles, encode_fn, on_invalid)
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "tok_ids", "tok_labels"))).alias("_parts"))
    ids = F.flatten(F.transform("_parts", lambda p: p["tok_ids"]))
    labels = F.flatten(F.transform("_parts", lambda p: p["tok_labels"]))
    g = g.select("conv_id", ids.alias("input_ids"), labels.alias("labels"))
    labels = F.when(any_supervised(F.col("labels")), F.col("labels")) \
        .otherwise(copy_fallback(F.col("labels"), F.col("input_ids")))
    return g.select("conv_id", "input_ids",
                    repeat(1, F.size("input_ids")).alias("attention_mask"),
                    labels.alias("labels"))


def explode_positions(df: DataFrame, key: str, cols: Iterable[str]) -> DataFrame:
    """One row per position of equal-length array columns: ``(key, pos, <col>...)``."""
    cols = list(cols)
    z = F.arrays_zip(*[F.col(c) for c in cols])
    out = df.select(key, F.posexplode(z).alias("pos", "_z"))
    return out.select(key, F.col("pos").cast("bigint").alias("pos"),
                      *[F.col("_z")[c].cast("bigint").alias(c) for c in cols])


def chat_layout_records(df: DataFrame, max_len: int, eos_id: int,
                        human_roles: Iterable[str] = DEFAULT_HUMAN_ROLES,
                        encode_fn: Encoder = codepoints, conv_col: str = "conversations",
                        keep: Iterable[str] = ()) -> DataFrame:
    """L1 on nested records (``conversations ARRAY<STRUCT<from, value>>``).

    A whole conversation is one row here, so the layout is a per-row
    expression: no shuffle, and it also runs on a streaming DataFrame. Same
    result as ``chat_layout`` on the exploded turns; an empty list gives three
    empty arrays (D20). A NULL turn value fails the job (D6).
    """
    limit = max_len - 1
    if limit < 1:
        raise ValueError("max_len must be >= 2")
    null_value = F.exists(conv_col, lambda t: t["value"].isNull())
    x = df.filter(F.when(null_value, F.raise_error(F.lit("NULL text in conversations.value")))
                  .otherwise(F.lit(True)))

    def turn_parts(t):
        human = is_human(t["from"], human_roles)
        ids = encode_fn(human_template(t["value"], human))
        sup_ids = F.concat(ids, int_array(eos_id))
        return F.struct(F.when(human, ids).otherwise(sup_ids).alias("ids"),
                        F.when(human, repeat(IGNORE_INDEX, F.size(ids))).otherwise(sup_ids).alias("labels"))

    parts = F.transform(F.coalesce(F.col(conv_col), F.array()), turn_parts)
    x = x.select(*keep, parts.alias("_parts"))
    ids = F.slice(F.flatten(F.transform("_parts", lambda p: p["ids"])), 1, limit)
    labels = F.slice(F.flatten(F.transform("_parts", lambda p: p["labels"])), 1, limit)
    x = x.select(*keep, F.coalesce(ids, empty_ints()).alias("input_ids"),
                 F.coalesce(labels, empty_ints()).alias("labels"))
    labels = F.when(any_supervised(F.col("labels")), F.col("labels")) \
        .otherwise(copy_fallback(F.col("labels"), F.col("input_ids")))
    return x.select(*keep, "input_ids", repeat(1, F.size("input_ids")).alias("attention_mask"),
                    labels.alias("labels"))
