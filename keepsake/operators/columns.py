"""Column choices: keep, drop, exclude, replace in place."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from keepsake.functions.cells import column


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the listed columns, in the listed order."""
    return df.select(*[column(c) for c in columns])


def drop(df: DataFrame, columns: Collection[str]) -> DataFrame:
    """All columns but the listed ones. A name that is not there is an error, not a no-op."""
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.drop(*columns)


def names_except(df: DataFrame, excluded: Collection[str]) -> list[str]:
    """Column names outside ``excluded``, in declared order."""
    return [c for c in df.columns if c not in excluded]


def replace(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Give columns new values under their old names and in their old places."""
    return df.withColumns(dict(values))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
