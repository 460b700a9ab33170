"""Where results go: CSV files, a stable preview, cached splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from keepsake.constants import PREVIEW_ROWS
from keepsake.functions.cells import column


def write_csv(df: DataFrame, path: str, key: Sequence[str], mode: str = "errorifexists") -> None:
    """Write CSV with a header, the key columns first. Each task writes its own part file."""
    rest = [c for c in df.columns if c not in key]
    ordered = df.select(*[column(c) for c in [*key, *rest]])
    ordered.write.mode(mode).csv(path, header=True, quote='"', escape='"')


def preview(df: DataFrame, order_by: Sequence[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows by key, so that the preview is the same on every run."""
    return df.orderBy(*[column(c) for c in order_by]).limit(rows)


def keep_in_memory(*tables: DataFrame) -> tuple[DataFrame, ...]:
    """Persist tables that several jobs read, spilling to disk what does not fit."""
    return tuple(t.persist(StorageLevel.MEMORY_AND_DISK) for t in tables)
