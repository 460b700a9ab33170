"""Delimited text to typed tables.

Two scans: lines without quoting, where every comma separates (the columns are known by
position), and files with a header line, where quotes are honoured (the columns are known by
name). Both read text and type the cells with column expressions, so unread columns are pruned
and an unreadable cell is NULL instead of a failed job.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.functions.cells import column, to_double_or_zero, to_type


def read_lines(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """One row per line: ``cells``, the line cut at every separator. Quotes mean nothing here."""
    return spark.read.text(path).select(
        F.split("value", re.escape(separator), -1).alias("cells")
    )


def pick_cells(
    lines: DataFrame, positions: Mapping[str, int], schema: T.StructType, fill: str | None = None
) -> DataFrame:
    """Name and type chosen positions of each line; a position past the end of a line is NULL.

    ``fill='zero'`` turns unreadable and missing numbers into 0.0; otherwise they stay NULL.
    """
    if fill not in (None, "zero"):
        raise ValueError(f"fill is None or 'zero', not {fill!r}")
    picked = []
    for name, position in positions.items():
        cell = F.get("cells", position)
        kind = schema[name].dataType.simpleString()
        value = to_double_or_zero(cell) if fill and kind == "double" else to_type(cell, kind)
        picked.append(value.alias(name))
    return lines.select(*picked)


def read_unquoted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    positions: Mapping[str, int] | None = None,
    fill: str | None = None,
) -> DataFrame:
    """Read headerless lines as ``schema``, by the given positions or else in schema order."""
    positions = positions or {name: i for i, name in enumerate(schema.names)}
    return pick_cells(read_lines(spark, path), positions, schema, fill)


def read_quoted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    separator: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """Read headerless CSV with quoting, in schema order. For ``multi_line`` see below."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    cells = spark.read.schema(text).csv(
        path, sep=separator, quote='"', escape='"', multiLine=multi_line
    )
    return cells.select(
        *[to_type(column(f.name), f.dataType.simpleString()).alias(f.name) for f in schema]
    )


def read_with_header(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    separator: str = ",",
    multi_line: bool = False,
    headers: str = "same",
    optional: Collection[str] = (),
) -> DataFrame:
    """Read CSV that has a header line, quotes honoured.

    ``types`` maps header names to string, double or boolean; only those columns are read, by
    name, in whatever order the files have them. Without it every column is read as text. No pass
    over the data infers anything; only header lines are looked at. A column that is not in the
    header is an error, which names it, unless it is ``optional``: then it is NULL.

    With ``headers='same'`` all files of a folder must have one header: a file with another one, or
    with another order of names, fails the read. With ``'each'`` every file is read by its own
    header: files with equal headers are scanned together, and the scans are united by name.

    ``multi_line`` allows line ends inside quoted cells. Such a file cannot be cut into parts, so
    one task reads it whole; leave it off for large files.
    """
    if headers not in ("same", "each"):
        raise ValueError(f"headers is 'same' or 'each', not {headers!r}")
    groups = [([path], path)]
    if headers == "each":
        found = files_by_header(spark, path, separator)
        groups = [(files, files[0]) for _, files in sorted(found.items())]
    scans = []
    for files, shown in groups:
        cells = spark.read.csv(
            files, header=True, enforceSchema=False, sep=separator, quote='"', escape='"',
            multiLine=multi_line,
        )
        scans.append(_typed(cells, types, optional, shown))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=types is None), scans)


def _typed(
    cells: DataFrame, types: Mapping[str, str] | None, optional: Collection[str], shown: str
) -> DataFrame:
    if types is None:
        return cells
    missing = [c for c in types if c not in cells.columns and c not in optional]
    if missing:
        raise ValueError(f"{shown} has no column {', '.join(missing)}")
    return cells.select(
        *[
            (to_type(column(c), kind) if c in cells.columns else F.lit(None).cast(kind)).alias(c)
            for c, kind in types.items()
        ]
    )


def files_by_header(
    spark: SparkSession, path: str, separator: str = ","
) -> dict[tuple[str, ...], list[str]]:
    """The files of a folder by the names in their header lines; files without a line are left out.

    Spark lists the files and reads one line of each, in small jobs side by side; file names and
    headers are all that reaches the driver. Two names that are equal in one header are an error.
    """
    files = sorted(spark.read.text(path).inputFiles())

    def header(file: str) -> tuple[str, ...] | None:
        line = spark.read.text(file).head()
        return tuple(next(csv.reader([line[0]], delimiter=separator), ())) if line else None

    with ThreadPoolExecutor(16) as pool:
        found: dict[tuple[str, ...], list[str]] = {}
        for file, names in zip(files, pool.map(header, files)):
            if names is None:
                continue
            if len(set(names)) < len(names):
                raise ValueError(f"{file} has a column name twice: {', '.join(names)}")
            found.setdefault(names, []).append(file)
    if not found:
        raise ValueError(f"{path} has no file with a header line")
    return found
