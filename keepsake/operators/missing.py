"""Missing values: counting and filling. NULL and NaN both count as missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer, SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.functions.cells import column


def is_missing(df: DataFrame, name: str) -> Column:
    value = column(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_rows, n_missing)`` for all columns, counted in one pass."""
    counted = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(is_missing(df, c)).alias("n_missing"),
        )
        for c in columns or df.columns
    ]
    return df.agg(F.array(*counted).alias("counted")).select(F.inline("counted"))


def columns_without_values(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that hold no value at all. They have no mean, so an imputer rejects them."""
    counts = df.agg(*[F.count_if(~is_missing(df, c)).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] == 0]


def mean_imputer(columns: Sequence[str]) -> Imputer:
    """Fill each column with its mean in the rows it is fitted on, under the same name."""
    return Imputer(strategy="mean", inputCols=list(columns), outputCols=list(columns))


def zero_filler(columns: Sequence[str]) -> SQLTransformer:
    """The stage that fills numbers and flags with 0.0, under the same name."""
    return _replaced(columns, "coalesce(nanvl(CAST({0} AS double), CAST(NULL AS double)), 0D)")


def flags_to_numbers(columns: Sequence[str]) -> SQLTransformer:
    """The stage that makes 0.0 and 1.0 of flags, so that they have a mean: their share of true."""
    return _replaced(columns, "CAST({0} AS double)")


def _replaced(columns: Sequence[str], expression: str) -> SQLTransformer:
    quoted = ["`" + c.replace("`", "``") + "`" for c in columns]
    made = ", ".join(f"{expression.format(c)} AS {c}" for c in quoted)
    return SQLTransformer(
        statement=f"SELECT * EXCEPT ({', '.join(quoted)}), {made} FROM __THIS__"
    )


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL and NaN by 0.0 in the given (default: all) floating-point columns."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    columns = floating if columns is None else columns
    return df.na.fill(0.0, subset=list(columns))
