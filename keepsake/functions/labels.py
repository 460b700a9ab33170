"""Binary labels. The positive class is always named, never taken from frequency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_vs_rest(value: Column, positive: str, rest: str) -> Column:
    """Keep ``positive``; every other value, NULL included, becomes ``rest``."""
    return F.when(value == positive, F.lit(positive)).otherwise(F.lit(rest))


def equals_label(value: Column, positive: object) -> Column:
    """1.0 where ``value`` equals the positive text or code, else 0.0 (NULL included)."""
    return F.when(value == F.lit(positive), 1.0).otherwise(0.0)
