"""Training data plan (one DataFrame lineage): read -> select -> layout ->
seeded shuffle -> steps -> collate -> parquet.

Shuffles: one for the chat layout (by conversation), one for the position
counts and ranking, one per micro-batch for the padding window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tunedata.operators import layouts, ordering
from tunedata.operators.profiles import resolve_profile
from tunedata.operators.templates import select_prompt_response
from tunedata.session import materialize
from tunedata.sources import readers, sinks
from tunedata.sources.outputs import Outputs, input_files


@dataclass
class TrainingData:
    model_name_or_path: str
    model_type: str
    layout: str = "pair"                 # "pair" (prompt/response) or "chat" (conversations)
    prompt_column: str = "input"
    response_column: str = "target"
    max_source_length: int = 1024
    max_target_length: int = 128
    model_max_length: int = 512
    human_roles: tuple = ("human",)
    mask_pad_labels: bool = False
    seed: int = 42
    devices: int = 1
    per_device_train_batch_size: int = 4
    gradient_accumulation_steps: int = 1
    max_steps: int | None = None
    repeat_epochs: bool = False          # with max_steps: reshuffle and repeat the data until reached
    multiline_json: bool = False
    json_array: bool = False             # one top-level array a file, read by many tasks
    fmt: str | None = None               # None: JSON by suffix; else parquet, orc or csv
    bucket_digits: int = 3               # 16^n buckets of the shuffle order; more for larger data
    preview_rows: int = 0                # first tokenized rows that ``build`` returns


# formatters by name. A formatter turns one split's file into
# (sequences, quarantined rows); users add their own with ``register_formatter``.
Formatter = Callable[[SparkSession, str, "TrainingData", str], "tuple[DataFrame, DataFrame]"]
FORMATTERS: dict[str, Formatter] = {}


def register_formatter(name: str, fn: Formatter) -> None:
    FORMATTERS[name] = fn


def sequences(spark: SparkSession, path: str, cfg: TrainingData, key: str = "example_id"
              ) -> tuple[DataFrame, DataFrame]:
    """Tokenized sequences of one split and its quarantined input rows, by the
    formatter named ``cfg.layout``."""
    if cfg.layout not in FORMATTERS:
        raise ValueError(f"unknown layout {cfg.layout!r}; known: {sorted(FORMATTERS)}")
    return FORMATTERS[cfg.layout](spark, path, cfg, key)


def content_key(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with a key that does not depend on files or splits: a hash of the row, and
    of the number of the copy among equal rows. Equal rows are counted (with
    partial sums, so copies do not meet in one place) and dealt out again."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    n = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    text = F.to_json(F.struct(*columns))
    return (n.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .withColumn(key, F.md5(F.concat_ws(":", F.col("_copy").cast("string"), text)))
            .select(key, *columns))


def _builtin_formatter(spark: SparkSession, path: str, cfg: TrainingData, key: str
                       ) -> tuple[DataFrame, DataFrame]:
    prof = resolve_profile(cfg.model_name_or_path, cfg.model_type)
    if cfg.layout == "pair":
        wanted = list(dict.fromkeys([cfg.prompt_column, cfg.response_column]))
        schema = StructType([StructField(c, StringType(), True) for c in wanted])
        raw = readers.read_examples(spark, path, schema, cfg.fmt, cfg.multiline_json, cfg.json_array)
        raw = raw.select(*wanted, *[c for c in (readers.CORRUPT,) if c in raw.columns])
        valid, bad = readers.split_valid(raw, wanted)
        sel = select_prompt_response(content_key(valid.select(*wanted), key), cfg.prompt_column,
                                     cfg.response_column, keep=[key])
        seqs = layouts.pair_layout(sel, cfg.max_source_length, cfg.max_target_length, prof.bos_id,
                                   prof.eos_id, prof.pad_id, mask_pad_labels=cfg.mask_pad_labels,
                                   keep=[key])
    elif cfg.layout == "chat":
        raw = readers.read_json(spark, path, readers.CHAT_SCHEMA, cfg.multiline_json, cfg.json_array)
        bad_row = F.col(readers.CORRUPT).isNotNull() | F.exists(
            F.coalesce("conversations", F.array()), lambda t: t["value"].isNull())
        valid, bad = raw.filter(~bad_row), raw.filter(bad_row)
        valid = content_key(valid.select("conversations"), key)
        seqs = layouts.chat_layout_records(valid, cfg.model_max_length, prof.eos_id, cfg.human_roles,
                                           keep=[key])
    else:
        raise ValueError(f"layout must be 'pair' or 'chat', got {cfg.layout!r}")
    return seqs, bad


register_formatter("pair", _builtin_formatter)
register_formatter("chat", _builtin_formatter)


def preview(seqs: DataFrame, key: str = "example_id", n: int = 1) -> list:
    """The first ``n`` tokenized rows by key, with their ids decoded
    (code-point encoder; special ids have no text, line breaks and tabs do), as
    plain rows on the driver (``n`` is small)."""
    from tunedata.functions.codec import codepoints_decode
    valid = F.filter("input_ids", lambda i: ((i >= 32) & (i <= 0x10FFFF) & ~i.between(0xD800, 0xDFFF))
                     | i.isin(9, 10, 13))
    return (seqs.orderBy(key).limit(n)
            .withColumn("decoded", codepoints_decode(valid)).collect())


def batches(seqs: DataFrame, cfg: TrainingData, pad_id: int, key: str = "example_id") -> DataFrame:
    """O1 -> L4 -> L3: shuffled, assigned to (step, rank, micro), padded per micro-batch.

    The sequences are made and written once; positions, steps and padded lengths are found on
    the keys and lengths read back from there, and the token arrays are joined once, at the end."""
    stored = materialize(seqs.withColumn("_len", F.size("input_ids")), how="table")
    seqs, thin = stored.drop("_len"), stored.select(key, "_len")
    if cfg.repeat_epochs and cfg.max_steps is not None:
        steps = ordering.epoch_plan(thin, key, cfg.seed, cfg.devices, cfg.per_device_train_batch_size,
                                    cfg.gradient_accumulation_steps, cfg.max_steps,
                                    bucket_digits=cfg.bucket_digits)
    else:
        steps = ordering.step_plan(thin, key, cfg.seed, cfg.devices, cfg.per_device_train_batch_size,
                                   cfg.gradient_accumulation_steps, cfg.max_steps, cfg.bucket_digits)
    return ordering.collate_thin(seqs, steps, key, "_len", pad_id)


def build(spark: SparkSession, train_file: str, output_dir: str, cfg: TrainingData,
          validation_file: str | None = None, overwrite: bool = False) -> dict:
    """Write ``<out>/train`` (batched) and ``<out>/validation`` (formatted like training rows,
    with their shuffled position), plus ``<out>/quarantine/<split>``, as one commit; returns the
    written paths and, if asked for, the first tokenized rows as ``preview``.

    A stopped job is gone on with when it is started again with the same settings and inputs:
    finished outputs are kept (``Outputs``)."""
    prof = resolve_profile(cfg.model_name_or_path, cfg.model_type)
    settings = {k: v for k, v in asdict(cfg).items() if k != "preview_rows"}
    job = Outputs(spark, output_dir, {**settings, "inputs": [input_files(spark, f) for f in (train_file, validation_file)],
                                      "files": [train_file, validation_file]}, overwrite)

    def written(df: Callable[[], DataFrame]) -> Callable[[str], None]:
        return lambda path: sinks.write_sequences(df(), path, overwrite=True)

    seqs, bad = sequences(spark, train_file, cfg)
    pad_id = prof.pad_id if prof.pad_id is not None else 0
    out = {"train": job.part("train", written(lambda: batches(seqs, cfg, pad_id))),
           "quarantine_train": job.part("quarantine/train", written(lambda: bad))}
    if validation_file is not None:
        vseqs, vbad = sequences(spark, validation_file, cfg)
        out["validation"] = job.part("validation", written(lambda: ordering.shuffled_positions(
            vseqs, "example_id", cfg.seed, bucket_digits=cfg.bucket_digits)))
        out["quarantine_validation"] = job.part("quarantine/validation", written(lambda: vbad))
    job.commit()
    if cfg.preview_rows:
        out["preview"] = preview(seqs, n=cfg.preview_rows)
    return out
