"""Column statistics, correlation with a target, category counts and class weights."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.constants import TOP_CORRELATIONS
from keepsake.functions.cells import column, without_nan
from keepsake.functions.moments import PAIR_SUMS, pair_sums


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n, mean, std_pop, std_samp)`` over present values, all columns in one pass."""
    measured = []
    for c in columns:
        value = _number(c)
        measured.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(value).alias("n"),
                F.avg(value).alias("mean"),
                F.stddev_pop(value).alias("std_pop"),
                F.stddev_samp(value).alias("std_samp"),
            )
        )
    return df.agg(F.array(*measured).alias("stats")).select(F.inline("stats"))


def correlations(
    df: DataFrame, target: str, columns: Sequence[str], include_target: bool = True
) -> DataFrame:
    """``(feature, r)``: Pearson correlation of each column with the target, in one pass.

    Each pair uses the rows where both values are present and finite. A column without variance
    has NULL.
    """
    features = [*columns, target] if include_target and target not in columns else list(columns)
    y = _finite(target)
    measured = []
    for feature in features:
        # Both sides are masked to complete pairs: covar_pop does that by itself, the deviations
        # do not. F.corr is not used because it divides by zero on a constant column.
        x = _finite(feature)
        both = x.isNotNull() & y.isNotNull()
        spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
        r = without_nan(F.try_divide(F.covar_pop(x, y), spread))
        measured.append(F.struct(F.lit(feature).alias("feature"), r.alias("r")))
    return df.agg(F.array(*measured).alias("r")).select(F.inline("r"))


def top_correlations(
    df: DataFrame,
    target: str,
    columns: Sequence[str],
    rows: int = TOP_CORRELATIONS,
    include_target: bool = True,
) -> DataFrame:
    """The highest correlations with the target. The target itself (r = 1) takes a place."""
    ranked = correlations(df, target, columns, include_target)
    return ranked.orderBy(F.desc_nulls_last("r"), "feature").limit(rows)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x, y, r)`` for every ordered pair of columns, over complete pairs.

    The number of pairs grows with the square of the columns. One aggregate expression per pair
    soon makes code too large to compile (17 columns took 40 times as long that way), so each
    task multiplies its rows as blocks and hands on one row of sums per pair. A first pass takes
    the means, which are subtracted to keep the sums precise.
    """
    numbers = df.select(*[_finite(c).alias(f"c{i}") for i, c in enumerate(columns)])
    means = numbers.agg(*[F.avg(c) for c in numbers.columns]).first()
    shift = [m if m is not None and math.isfinite(m) else 0.0 for m in means]
    sums = numbers.mapInArrow(lambda batches: pair_sums(batches, shift), PAIR_SUMS)
    added = ("n", "sx", "sy", "sxx", "syy", "sxy")
    pairs = sums.groupBy("x", "y").agg(
        *[F.sum(c).alias(c) for c in added],
        *[F.min(c).alias(c) for c in ("low_x", "low_y")],
        *[F.max(c).alias(c) for c in ("high_x", "high_y")],
    )

    def spread(total: str, square: str) -> Column:
        return F.sqrt(F.greatest(F.col("n") * F.col(square) - F.col(total) ** 2, F.lit(0.0)))

    covariance = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    varied = (F.col("low_x") < F.col("high_x")) & (F.col("low_y") < F.col("high_y"))
    r = F.when(varied, F.try_divide(covariance, spread("sx", "sxx") * spread("sy", "syy")))
    names = F.array(*[F.lit(c) for c in columns])
    half = pairs.select(
        F.get(names, F.col("x")).alias("x"), F.get(names, F.col("y")).alias("y"),
        without_nan(r).alias("r"),
    )
    there = F.struct("x", "y", "r")
    back = F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r")
    both = F.when(F.col("x") == F.col("y"), F.array(there)).otherwise(F.array(there, back))
    return half.select(F.inline(both))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for several text columns in one pass; NULLs are not counted.

    Counts are combined before the shuffle, so a value that fills most rows costs one record
    per task.
    """
    text = df.select(*[column(c).cast("string").alias(c) for c in columns])
    cells = text.unpivot([], [column(c) for c in columns], "column", "value")
    return cells.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)``: weights inversely proportional to class frequency.

    A class holding an even share has weight 1. The totals are scalar subqueries over the same
    counts, so the rows are read once and no window spans the table.
    """
    counts = df.groupBy(column(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    classes = counts.agg(F.count(F.lit(1)).cast("double")).scalar()
    return counts.select("label", "n", (total / (classes * F.col("n"))).alias("weight"))


def with_class_weight(
    df: DataFrame, train: DataFrame, label: str, weight: str = "weight", literals: int = 100
) -> DataFrame:
    """Add to ``df`` the class weights found in ``train``; a class that it lacks has NULL.

    Up to ``literals`` classes, the weights become a literal lookup in the row expression. A table
    of more is joined, by whatever join suits its size.
    """
    weights = class_weights(train, label)
    found = weights.limit(literals + 1).collect()
    if len(found) > literals:
        other = weights.select(F.col("label").alias("_class"), F.col("weight").alias(weight))
        return df.join(other, column(label).eqNullSafe(F.col("_class")), "left").drop("_class")
    value = F.lit(None).cast("double")
    for row in found:
        value = F.when(column(label).eqNullSafe(F.lit(row["label"])), row["weight"]).otherwise(
            value
        )
    return df.withColumn(weight, value)


def _finite(name: str) -> Column:
    value = _number(name)
    return F.when(F.abs(value) < float("inf"), value)


def _number(name: str) -> Column:
    return without_nan(column(name).cast("double"))
