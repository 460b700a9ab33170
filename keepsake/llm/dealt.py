"""Numbers dealt to destinations by hash, as packed arrays instead of a row for each number.

A task cuts its arrays by destination and sends one row of binary columns to each; Spark shuffles
these rows, and a destination's group holds about as many numbers as `destinations` was asked for.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


def destinations(numbers: float, each: int = 1 << 19) -> int:
    """So many destinations that one gets about `each` numbers, whatever their total."""
    return max(1, -(-int(numbers) // each))


def deal(dest: np.ndarray, arrays: dict[str, np.ndarray]) -> pd.DataFrame:
    """A row (dest, one binary column for each array) for every destination that gets something;
    within it the order is kept."""
    order = np.argsort(dest, kind="stable")
    there, first = np.unique(dest[order], return_index=True)
    cuts = [*first.tolist(), len(order)]
    rows = {"dest": there.astype(np.int32)}
    for name, values in arrays.items():
        moved = values[order]
        rows[name] = [moved[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    return pd.DataFrame(rows)


def joined(column: pd.Series, kind: str) -> np.ndarray:
    """The arrays of a binary column, one after another."""
    return np.frombuffer(b"".join(column), kind)


def same(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows over equally long arrays: an order that puts equal rows side by side and keeps them
    in their own order, and which rows of it begin a group."""
    order = np.lexsort(columns)
    begins = np.ones(len(order), bool)
    if len(order):
        begins[1:] = False
        for values in columns:
            values = values[order]
            begins[1:] |= values[1:] != values[:-1]
    return order, begins


def how_often(*columns: np.ndarray) -> np.ndarray:
    """Of every row over equally long arrays: how many rows are equal to it, itself included."""
    order, begins = same(*columns)
    group = np.cumsum(begins) - 1
    out = np.empty(len(order), np.int64)
    out[order] = np.bincount(group)[group] if len(group) else 0
    return out
