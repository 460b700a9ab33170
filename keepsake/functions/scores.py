"""Score arrays and vectors: softmax, argmax, dense form. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(scores: Column) -> Column:
    """Class probabilities of a score array, shifted by its maximum so that exp cannot overflow."""

    def divided(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
        return _once(total, lambda t: F.transform(powers, lambda x: x / t))

    powers = _once(
        F.array_max(scores).cast("double"),
        lambda top: F.transform(scores, lambda x: F.exp(x.cast("double") - top)),
    )
    return _once(powers, divided)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it.

    A plain Column is an expression, and inside a lambda it would be computed per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def argmax(scores: Column) -> Column:
    """Zero-based place of the largest score; the first one wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def dense(vector: Column) -> Column:
    """The same vector in dense form."""
    return array_to_vector(vector_to_array(vector))


def element(vector: Column, position: int) -> Column:
    """One element of an ML vector as a double."""
    return F.get(vector_to_array(vector), position)
