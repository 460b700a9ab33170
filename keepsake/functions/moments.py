"""Sums over column pairs, as matrix products of row blocks inside a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

PAIR_SUMS = "x int, y int, " + ", ".join(
    f"{name} double"
    for name in ("n", "sx", "sy", "sxx", "syy", "sxy", "low_x", "high_x", "low_y", "high_y")
)


def pair_sums(batches: Iterable[pa.RecordBatch], shift: Sequence[float]) -> Iterator[pa.RecordBatch]:
    """One row per column pair with x <= y, over the rows where both values are present.

    Missing values are NULL. ``shift`` is taken off each column, to keep the sums of squares
    small. The output has the columns of PAIR_SUMS and does not grow with the input.
    """
    width = len(shift)
    count, total, square, product = (np.zeros((width, width)) for _ in range(4))
    low, high = np.full((width, width), np.inf), np.full((width, width), -np.inf)
    for batch in batches:
        rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows = rows - np.asarray(shift)
        present = ~np.isnan(rows)
        filled, mask = np.where(present, rows, 0.0), present.astype(float)
        # [i, j] is about column i in the rows where column j is present too.
        count += mask.T @ mask
        total += filled.T @ mask
        square += (filled * filled).T @ mask
        product += filled.T @ filled
        least, most = np.where(present, rows, np.inf), np.where(present, rows, -np.inf)
        for j in range(width):
            at = slice(None) if present[:, j].all() else present[:, j]
            low[:, j] = np.minimum(low[:, j], least[at].min(axis=0, initial=np.inf))
            high[:, j] = np.maximum(high[:, j], most[at].max(axis=0, initial=-np.inf))
    x, y = np.triu_indices(width)
    values = [count[x, y], total[x, y], total[y, x], square[x, y], square[y, x], product[x, y],
              low[x, y], high[x, y], low[y, x], high[y, x]]
    names = [field.split()[0] for field in PAIR_SUMS.split(", ")]
    columns = [pa.array(i.astype(np.int32)) for i in (x, y)] + [pa.array(v) for v in values]
    yield pa.RecordBatch.from_arrays(columns, names=names)
