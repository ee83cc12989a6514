"""Batch prediction with a user-supplied predictor.

The predictor is built once per Python worker by a factory (a picklable
callable), then called on Arrow batches of prompts: ``list[str] -> list[str]``,
each output being the full generated text (prompt included, as a decoder
returns it). Removing the prompt and attaching the column are JVM-side.
"""

from __future__ import annotations

import inspect
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tunedata.functions.text import strip_prompt

Predictor = Callable[[Sequence[str]], Sequence[str]]
PredictorFactory = Callable[[], Predictor]

_WORKER_CACHE: dict[str, Predictor] = {}


def _predictor(factory: PredictorFactory, key: str) -> Predictor:
    """One predictor per Python worker process and ``generate`` call (tasks re-unpickle the
    factory, so it is known by the call's own key: other lambdas, closures or
    parameters of one factory never share a predictor)."""
    if key not in _WORKER_CACHE:
        _WORKER_CACHE.clear()
        _WORKER_CACHE[key] = factory()
    return _WORKER_CACHE[key]


def with_settings(factory: Callable, settings: dict) -> PredictorFactory:
    """The factory with the generation settings as its argument, if it takes one."""
    takes = [q for q in inspect.signature(factory).parameters.values()
             if q.kind in (q.POSITIONAL_ONLY, q.POSITIONAL_OR_KEYWORD) and q.default is q.empty]
    return partial(factory, dict(settings)) if takes else factory


class EchoReverse:
    """Deterministic stand-in model: generates the prompt followed by its reverse."""

    def __call__(self, prompts: Sequence[str]) -> list[str]:
        return [p + p[::-1] for p in prompts]


def echo_reverse() -> Predictor:
    return EchoReverse()


# Most rows, and characters of prompts, that are sorted by length before they are cut into batches.
SORTED_ROWS, SORTED_CHARS = 4096, 1 << 20


def outputs(model: Predictor, prompts: Sequence, batch_size: int, errors: list | None) -> list:
    """The model's outputs in the prompts' order; prompts of similar length share a batch.

    Without ``errors`` a failing batch fails the job. With it, the batch is halved until the
    rows that fail on their own are left; these give None, and their message in ``errors``.
    """
    out: list = [None] * len(prompts)

    def run(rows: list) -> None:
        try:
            made = list(model([prompts[i] for i in rows]))
            if len(made) != len(rows):
                raise RuntimeError(f"predictor returned {len(made)} rows for {len(rows)}")
        except Exception as e:  # noqa: BLE001 - whatever a user's model raises
            if errors is None:
                raise
            if len(rows) == 1:
                errors[rows[0]] = f"{type(e).__name__}: {e}"
                return
            run(rows[:len(rows) // 2])
            run(rows[len(rows) // 2:])
            return
        for i, text in zip(rows, made, strict=True):
            out[i] = text

    order = sorted(range(len(prompts)), key=lambda i: (len(prompts[i]), i))
    for at in range(0, len(order), batch_size):
        run(order[at:at + batch_size])
    return out


def generate(df: DataFrame, prompt_col: str, factory: PredictorFactory, out_col: str = "generated",
             batch_size: int = 64, error_col: str | None = None, profile=None) -> DataFrame:
    """Run the predictor over ``prompt_col`` in batches; all input columns pass through.

    Rows of one Arrow stream are taken ``SORTED_ROWS`` or ``SORTED_CHARS`` at a time and batched by prompt length, so
    a batch has little padding; they come out in their order, and every batch's row count is checked.
    With ``error_col`` a prompt that the predictor fails on has no output and the error in that
    column (D6: to be quarantined); null prompts are such rows. ``profile`` is a Spark resource
    profile for the stage (accelerators, memory of the Python workers).
    """
    from tunedata.session import ship_package
    ship_package(df.sparkSession)
    added = [StructField(c, StringType(), True) for c in (out_col, error_col) if c]
    schema = StructType(df.schema.fields + added)
    key = uuid.uuid4().hex

    def answered(frames: list, model: Predictor) -> pd.DataFrame:
        pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        prompts = pdf[prompt_col].tolist()
        if error_col is None:
            return pdf.assign(**{out_col: outputs(model, prompts, batch_size, None)})
        missing = [p is None for p in prompts]
        errors = ["ValueError: no prompt" if none else None for none in missing]
        there = [i for i, none in enumerate(missing) if not none]
        failed: list = [None] * len(there)
        found = outputs(model, [prompts[i] for i in there], batch_size, failed)
        texts: list = [None] * len(prompts)
        for i, text, error in zip(there, found, failed, strict=True):
            texts[i], errors[i] = text, error
        return pdf.assign(**{out_col: texts, error_col: errors})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _predictor(factory, key)
        held: list = []
        rows = chars = 0
        for pdf in batches:
            at = 0
            # Ends of the parts: behind the row that fills one up.
            for i, prompt in enumerate(pdf[prompt_col].tolist(), 1):
                rows, chars = rows + 1, chars + len(prompt or "")
                if rows >= SORTED_ROWS or chars >= SORTED_CHARS:
                    yield answered([*held, pdf.iloc[at:i]], model)
                    held, at, rows, chars = [], i, 0, 0
            if at < len(pdf):
                held.append(pdf.iloc[at:])
        if held:
            yield answered(held, model)

    return df.mapInPandas(run, schema, profile=profile)


def batch_predict(df: DataFrame, prompt_col: str, factory: PredictorFactory, batch_size: int = 64,
                  prefix_only: bool = False, error_col: str | None = None, profile=None) -> DataFrame:
    """Generate, remove the prompt text from the output (D11), attach ``prediction``."""
    g = generate(df, prompt_col, factory, "_generated", batch_size, error_col, profile)
    return g.withColumn("prediction", strip_prompt(F.col("_generated"), F.col(prompt_col),
                                                   prefix_only)).drop("_generated")


def prompt_ids(df: DataFrame, prompt_col: str, eos_id: int, bos_id: int | None,
               add_separator: bool = False, encode_fn=None, out_col: str = "input_ids") -> DataFrame:
    """The ids a predictor gets for a prompt. By default the encoded
    prompt alone; ``add_separator`` appends ``eos, bos`` as the pair layout puts
    between prompt and answer in training (a missing bos is written as 0)."""
    from tunedata.functions.arrays import int_array
    from tunedata.functions.codec import codepoints
    ids = (encode_fn or codepoints)(F.col(prompt_col))
    if add_separator:
        ids = F.concat(ids, int_array(eos_id, 0 if bos_id is None else bos_id))
    return df.withColumn(out_col, ids)
