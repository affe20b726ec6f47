"""Shapes of plans: values that are computed once."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), 0)


def computed(df: DataFrame, keep: Sequence[Column | str], values: Sequence[Column]) -> DataFrame:
    """Select ``keep`` and ``values``, with the values fixed at this point of the plan.

    The optimizer moves filters below projections by copying the projected expressions into
    them, once per mention; for a parse or a tokenization that repeats the work. Filters do
    not move below a generator, so the values pass through one that yields a single row.
    """
    return df.select(*keep, F.inline_outer(F.array(F.struct(*values))))
