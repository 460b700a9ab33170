"""Declared schemas of the two studies' files and readers bound to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake import constants as C
from keepsake.functions.cells import column, is_yes, to_double
from keepsake.functions.labels import equals_label, one_vs_rest
from keepsake.sources.delimited import pick_cells, read_lines, read_unquoted, read_with_header


def churn_schema() -> T.StructType:
    return T.StructType.fromDDL(C.CHURN_DDL)


def renewal_schema() -> T.StructType:
    fields = [T.StructField(c, T.DoubleType()) for c in C.RENEWAL_FEATURES]
    return T.StructType([*fields, T.StructField("label", T.StringType())])


def read_churn(spark: SparkSession, path: str) -> DataFrame:
    """Headerless churn lines: 21 typed columns."""
    return read_unquoted(spark, path, churn_schema())


def read_churn_with_header(spark: SparkSession, path: str) -> DataFrame:
    """Churn CSV with a header: flags by exact ``yes``, 0/1 label, identifying columns dropped.

    The remaining columns keep their header names and are read as numbers. Without a label column,
    as in files that are still to be scored, the label is NULL.
    """
    raw = read_with_header(spark, path)
    features = [c for c in raw.columns if c not in C.CHURN_HEADER_DROPPED]
    typed = [
        (is_yes(column(c)) if c in C.CHURN_HEADER_FLAGS else to_double(column(c))).alias(c)
        for c in features
    ]
    label = F.lit(None).cast("double")
    if C.CHURN_HEADER_LABEL in raw.columns:
        label = equals_label(column(C.CHURN_HEADER_LABEL), C.CHURN_LABELS[1])
    return raw.select(*typed, label.alias("label"))


def read_renewal(spark: SparkSession, path: str, fill: str | None = None) -> DataFrame:
    """Headerless renewal lines: ten numbers by position and a two-valued label."""
    positions = {**C.RENEWAL_POSITIONS, "label": C.RENEWAL_LABEL_POSITION}
    picked = pick_cells(read_lines(spark, path), positions, renewal_schema(), fill)
    negative, positive = C.RENEWAL_LABELS
    return picked.withColumn("label", one_vs_rest(F.col("label"), positive, negative))


def read_renewal_with_header(
    spark: SparkSession, path: str, label_column: str = C.RENEWAL_HEADER_LABEL
) -> DataFrame:
    """Renewal CSV with a header: ten numbers and the label column, text or numeric code.

    Without the label column, as in files that are still to be scored, it is NULL.
    """
    kind = "double" if label_column == C.RENEWAL_HEADER_CODE else "string"
    types = {**{c: "double" for c in C.RENEWAL_FEATURES}, label_column: kind}
    return read_with_header(spark, path, types, optional=(label_column,))
