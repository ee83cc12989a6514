"""Array helpers for token sequences (F-arr-*, F-math-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: label that marks a position as not supervised.
IGNORE_INDEX = -100
# Positions (0-based, end exclusive) that get their ids copied
# into the labels when a chat example has no supervised position at all.
FALLBACK_START = 18
FALLBACK_END = 24


def int_array(*values) -> Column:
    return F.array(*[F.lit(v).cast("int") if not isinstance(v, Column) else v.cast("int")
                     for v in values]).cast("array<int>")


def empty_ints() -> Column:
    return F.array().cast("array<int>")


def repeat(value, n) -> Column:
    """F-arr-2: ``[value] * n``; a count at or below zero gives an empty array."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.array_repeat(v.cast("int"), F.greatest(n.cast("int"), F.lit(0)))


def any_supervised(labels) -> Column:
    """A2 / F-arr-6: some label is above IGNORE_INDEX."""
    return F.exists(labels, lambda x: x > F.lit(IGNORE_INDEX))


def copy_fallback(labels: Column, ids: Column) -> Column:
    """F-arr-4: ``labels[18:24] = ids[18:24]`` on equal-length arrays."""
    return F.transform(labels, lambda x, i: F.when(
        (i >= FALLBACK_START) & (i < FALLBACK_END), F.element_at(ids, i + 1)).otherwise(x))


def round_up(n: Column, multiple: int) -> Column:
    """F-math-2: round ``n`` up to a multiple."""
    return (F.ceil(n / F.lit(multiple)) * F.lit(multiple)).cast("int")
