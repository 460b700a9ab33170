"""Holdout splits by row key: reproducible, disjoint and complete under any partitioning.

A row's side depends only on its key and the seed, never on row order, partition or retry. Equal
keys fall on one side of a hash split, so copies of a row cannot sit in both train and test. An exact
split cuts through at most one key, the last one of the test part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, UserDefinedType

from keepsake.constants import SHARE_QUARTER
from keepsake.functions.cells import column
from keepsake.functions.keys import HASH_DIGITS, key_hash, share_bound

DEFAULT_SEED = 7

# Exact splits look for one hash by histogram: 16 ** 3 counts per pass come to the driver, and
# the last step sorts at most this many hashes.
_DIGITS_PER_PASS = 3
_SORTABLE = 50_000


def held_out(key: Sequence[str], share: float, seed: int = DEFAULT_SEED) -> Column:
    """True for rows in the test part. A filter on it needs no shuffle and no extra pass."""
    return key_hash(key, seed) < F.lit(share_bound(share))


def split(
    df: DataFrame,
    key: Sequence[str],
    share: float,
    seed: int = DEFAULT_SEED,
    hashed: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with about ``share`` of the rows in test. ``hashed`` as in `split_exact`."""
    test = held_out(key, share, seed)
    if hashed:
        test = column(hashed) < F.lit(share_bound(share))
    return _without(df.where(~test), hashed), _without(df.where(test), hashed)


def split_exact(
    df: DataFrame,
    key: Sequence[str],
    share: float = SHARE_QUARTER,
    seed: int = DEFAULT_SEED,
    hashed: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with exactly ``ceil(rows * share)`` rows in test: those with the smallest
    key hashes.

    Rows are never sorted as a whole. Passes over the key columns count hashes by leading digits
    and narrow down to the last hash that belongs in the test part; the split is then one
    comparison per row. Where several rows share that last key, they are told apart by a hash of
    the whole row, vectors as their elements. Only the copies of one row, equal in every column, can
    end up on both sides: as many of them as the size asks for.

    ``hashed`` names a column that holds ``key_hash(key, seed)`` already; it is no part of the row,
    and of neither result. In a persisted table it spares each pass, and each reading of either part,
    the making of the hashes, which costs more than all the rest.
    """
    first = column(hashed) if hashed else key_hash(key, seed)
    train, test = _divided(df, first, share, [f for f in df.schema if f.name != hashed])
    return _without(train, hashed), _without(test, hashed)


def _without(df: DataFrame, hashed: str | None) -> DataFrame:
    return df.drop(column(hashed)) if hashed else df


def _divided(
    df: DataFrame, first: Column, share: float, fields: Sequence[StructField]
) -> tuple[DataFrame, DataFrame]:
    hashes = df.select(first.alias("hash"))
    rows, last, missing = _smallest(hashes, lambda n: math.ceil(n * share))
    if rows == 0 or last is None:
        return df, df.where(F.lit(False))
    if missing == 0:
        test = first <= F.lit(last)
        return df.where(~test), df.where(test)
    second = F.md5(F.to_json(F.struct(*[_hashable(f) for f in fields])))
    at_last = first == F.lit(last)
    _, last_row, copies = _smallest(df.where(at_last).select(second.alias("hash")),
                                    lambda _: missing)
    if copies == 0:
        test = (first < F.lit(last)) | (at_last & (second <= F.lit(last_row)))
        return df.where(~test), df.where(test)
    below = (first < F.lit(last)) | (at_last & (second < F.lit(last_row)))
    tied = at_last & (second == F.lit(last_row))
    equal = df.where(tied)
    train, test = df.where(~below & ~tied), df.where(below)
    rest = equal.count() - copies
    return train.unionAll(_repeat(equal, rest)), test.unionAll(_repeat(equal, copies))


def _hashable(field: StructField) -> Column:
    """A column as JSON can hold it: vectors as arrays, so that equal ones are equal in any form."""
    if isinstance(field.dataType, VectorUDT):
        return vector_to_array(column(field.name)).alias(field.name)
    if isinstance(field.dataType, UserDefinedType):
        raise ValueError(f"rows that tie can't be told apart by {field.name}; leave it out")
    return column(field.name)


def _repeat(equal: DataFrame, times: int) -> DataFrame:
    """One of the equal rows, so many times, made in as many tasks as a shuffle has."""
    if times == 0:
        return equal.where(F.lit(False))
    parts = min(times, int(equal.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = equal.limit(1).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    own = F.lit(times // parts) + F.when(F.col("_part") < times % parts, 1).otherwise(0)
    made = dealt.repartition(parts, "_part").withColumn("_n", F.explode(F.sequence(F.lit(1), own)))
    return made.select(*[column(c) for c in equal.columns])


def _smallest(hashes: DataFrame, wanted) -> tuple[int, str | None, int]:
    """``(rows, last, missing)``: the hash of the ``wanted(rows)``-th row in hash order.

    ``missing`` is 0 if exactly that many rows are at or below ``last``; otherwise several rows
    carry ``last`` and only ``missing`` of them are wanted.
    """
    prefix, rows, rest = "", None, None
    while True:
        width = min(len(prefix) + _DIGITS_PER_PASS, HASH_DIGITS)
        counted = (
            hashes.where(F.col("hash").startswith(prefix))
            .groupBy(F.substring("hash", 1, width).alias("lead"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("low"),
                 F.max("hash").alias("high"))
            .collect()
        )
        if rows is None:
            rows = sum(r.n for r in counted)
            rest = wanted(rows)
            if rest == 0:
                return rows, None, 0
        for found in sorted(counted, key=lambda r: r.lead):
            if rest <= found.n:
                break
            rest -= found.n
        if rest == found.n:
            return rows, found.high, 0
        if found.low == found.high:
            return rows, found.low, rest
        prefix = found.lead
        if found.n <= _SORTABLE:
            break
    near = hashes.where(F.col("hash").startswith(prefix)).orderBy("hash").limit(rest + 1).collect()
    last = near[rest - 1].hash
    if near[rest].hash != last:
        return rows, last, 0
    return rows, last, sum(r.hash == last for r in near[:rest])
