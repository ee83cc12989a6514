"""Column selection and prompt assembly."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def select_prompt_response(df: DataFrame, prompt_column: str, response_column: str,
                           keep: Iterable[str] = ()) -> DataFrame:
    """P1 + P2: pick the two text columns by name; every other column is dropped
    (only ``keep`` survives), so the scan reads just these columns."""
    missing = [c for c in (prompt_column, response_column) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(*keep, F.col(prompt_column).alias("prompt"),
                     F.col(response_column).alias("response"))


def assemble_prompt(df: DataFrame, instruction_col: str = "instruction",
                    input_col: str = "input", first_char: bool = False,
                    out_col: str = "prompt") -> DataFrame:
    """P5 (D9): first instruction + input.

    An ``ARRAY<STRING>`` instruction contributes its first element; an empty
    array fails the row's job. A plain string instruction contributes the whole
    string, or its first character with ``first_char=True`` (what indexing a
    string does).
    """
    dtype = df.schema[instruction_col].dataType
    ins = F.col(instruction_col)
    if isinstance(dtype, ArrayType):
        first = F.when(F.size(ins) > 0, F.element_at(ins, 1)).otherwise(
            F.raise_error(F.lit("empty instruction list")).cast("string"))
    elif isinstance(dtype, StringType):
        first = F.substring(ins, 1, 1) if first_char else ins
    else:
        raise TypeError(f"instruction column must be array<string> or string, got {dtype}")
    return df.withColumn(out_col, F.concat(first, F.col(input_col)))


def txt_output(df: DataFrame, prompt_col: str = "value",
               prediction_col: str = "prediction") -> DataFrame:
    """P6 + P8: a txt line is its own prompt; output columns ``Input``, ``Output``."""
    return df.select(F.col(prompt_col).alias("Input"), F.col(prediction_col).alias("Output"))
