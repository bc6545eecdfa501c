"""Functions over score vectors held as array<double>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), which is no map, with value computed once, however often the body reads it.

    The largest of one element is that element, and its type is worked out once; an element taken
    by its index has its type, which is that of the whole body, worked out anew for every row.
    """
    return F.array_max(F.transform(F.array(value), body))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    """Probabilities from logits, shifted by the largest so that exp can't overflow."""
    return let(
        F.array_max(logits),
        lambda top: let(
            F.transform(logits, lambda z: F.exp(z - top)),
            lambda exps: let(total(exps), lambda s: F.transform(exps, lambda e: e / s)),
        ),
    )


def argmax(values: Column) -> Column:
    """0-based position of the largest value; the first one on a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def entry(values: Column, index: Column) -> Column:
    """values[index] counted from 0; null when out of range."""
    return F.get(values, index.cast("int"))
