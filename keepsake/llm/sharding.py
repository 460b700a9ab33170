"""Sharding by extendible hashing, with DataFrame functions only.

A row's hash, 52 bits of the MD5 of its id and its text's digest, gives its bucket: all rows whose
hash begins with the same bits. Buckets split on one bit more as long as they are over the byte
limit, so the depth differs between buckets. Sizes are summed by leading bits before any shuffle,
and only rows of buckets that are still too large are looked at again with more bits. A limit of rows
does the same for rows of few or no bytes, which never reach the limit of bytes.

Rows with equal hashes, mostly copies of one row, cannot be split by bits. If they are over a limit
they are numbered in chunks of 65,536 rows at most and dealt by number, so no task holds all copies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from keepsake.llm.tables import fresh, stored

BITS = 52
MAX_BYTES = 1 << 20
MAX_ROWS = 1 << 16
# Bits beyond the expected depth that the first look takes, and that each further look adds.
_SPARE = 4
_STEP = 12
# Bits of a row's number within its partition: rows of one chunk, at most, when copies are numbered.
_CHUNK_BITS = 16


def n_bytes(text: Column) -> Column:
    """Bytes of a text in UTF-8; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """52 bits that depend on the id and the whole text; nulls are left out."""
    digest = F.md5(F.concat_ws("|", doc_id.cast("string"), F.md5(text.cast("binary"))))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def directory(
    rows: DataFrame, max_bytes: int = MAX_BYTES, max_rows: int = MAX_ROWS
) -> list[tuple[int, DataFrame, bool]]:
    """The directory of rows with `hash` and `n_bytes`: a list of (bits, cells, is_last).

    cells has (cell, depth, prefix, shard_bytes): rows whose hash begins with the `bits` bits of
    cell belong to the bucket of depth and prefix. A cell without a depth is too large at these
    bits and is continued by the next entry of the list; in the last entry, at 52 bits, its rows
    have equal hashes.
    """
    n_rows, total = rows.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    most = max(total / max_bytes, n_rows / max_rows, 1)
    bits = min(BITS, math.ceil(math.log2(most)) + _SPARE)
    done, found = 0, []
    while True:
        cell = F.shiftright("hash", BITS - bits)
        cells = rows.groupBy(cell.alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")
        )
        cells = stored(cells, "cells")
        depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(done), F.lit(bits))))
        prefix = F.expr(f"shiftright(cell, {bits} - depth)")
        depths = depths.withColumn("prefix", prefix)
        sizes = depths.groupBy("depth", "prefix").agg(
            F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("n")
        )
        fitting = sizes.where((F.col("shard_bytes") <= max_bytes) & (F.col("n") <= max_rows)).drop("n")
        leaf = depths.join(fitting, ["depth", "prefix"]).groupBy("cell").agg(
            F.min(F.struct("depth", "prefix", "shard_bytes")).alias("leaf")
        )
        table = cells.select("cell").join(leaf, "cell", "left").select("cell", "leaf.*")
        table = stored(table, "directory")
        found.append((bits, table, bits == BITS))
        if bits == BITS or table.where("depth is null").isEmpty():
            return found
        open_cells = table.where("depth is null").select("cell")
        rows = rows.withColumn("cell", cell).join(open_cells, "cell", "left_semi").drop("cell")
        done, bits = bits + 1, min(BITS, bits + _STEP)


def assign(
    rows: DataFrame,
    entries: list[tuple[int, DataFrame, bool]],
    max_bytes: int = MAX_BYTES,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Rows with `hash` and `n_bytes`, and any other columns, each with its shard.

    Adds depth, prefix, part and shard_bytes. part is 0, but for rows with equal hashes that are
    together over a limit: they are dealt to several parts, each within the limits unless it is a
    single row, for which shard_bytes is that of the part.
    """
    out = None
    for bits, table, is_last in entries:
        cell = F.shiftright("hash", BITS - bits)
        joined = rows.withColumn("cell", cell).join(table, "cell")
        placed = joined.where("depth is not null").withColumn("part", F.lit(0).cast("long"))
        if is_last:
            placed = placed.unionByName(_parts(joined.where("depth is null"), max_bytes, max_rows))
        placed = placed.drop("cell")
        out = placed if out is None else out.unionByName(placed)
        rows = rows.withColumn("cell", cell).join(
            table.where("depth is null").select("cell"), "cell", "left_semi"
        ).drop("cell")
    return out


def _parts(rows: DataFrame, max_bytes: int, max_rows: int) -> DataFrame:
    """Rows with equal hashes: those over half the limit each alone, the others by running sums.

    Rows of one hash and size are numbered chunk by chunk, and counted on from the chunks before.
    The rows are stored once, so that a repeated task finds the same numbers.
    """
    half = max(max_bytes // 2, 1)
    # What a row takes of a part's half limit; rows of few bytes take a row's share of it.
    weight = F.greatest("n_bytes", F.lit(-(-max_bytes // max_rows)))
    tied = stored(rows.withColumn("number", F.monotonically_increasing_id()), "copies")
    tied = tied.withColumn("chunk", F.shiftright("number", _CHUNK_BITS))
    keys = ["hash", "n_bytes", "chunk"]
    counts = tied.groupBy(*keys).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("hash", "heavy").orderBy("n_bytes", "chunk")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    heavy = weight > half
    offsets = counts.withColumn("heavy", heavy).select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_ahead"),
        F.coalesce(F.sum(F.col("n") * weight).over(earlier), F.lit(0)).alias("ahead"),
    )
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("number")) - 1
    placed = tied.withColumn("inside", inside).join(offsets, same)
    alone = 2 * (F.col("rows_ahead") + F.col("inside")) + 1
    dealt = 2 * F.floor((F.col("ahead") + F.col("inside") * weight) / half)
    placed = placed.withColumn("part", F.when(heavy, alone).otherwise(dealt).cast("long")).drop(
        *[f"_{k}" for k in keys], "rows_ahead", "ahead", "inside", "number", "chunk"
    )
    own = placed.groupBy(F.col("hash").alias("_hash"), F.col("part").alias("_part")).agg(
        F.sum("n_bytes").alias("own")
    )
    return (
        placed.join(own, [F.col("hash") == F.col("_hash"), F.col("part") == F.col("_part")])
        .withColumn("depth", F.lit(BITS))
        .withColumn("prefix", F.col("hash"))
        .withColumn("shard_bytes", F.col("own"))
        .drop("_hash", "_part", "own")
    )


def shard_rows(
    docs: DataFrame, max_bytes: int = MAX_BYTES, max_rows: int = MAX_ROWS
) -> DataFrame:
    """(key, n_bytes, depth, prefix, part, shard_bytes) for every row; key is its doc_id.

    Rows that share (depth, prefix, part) are one shard. A null or empty text has no bytes. Repeated
    rows have equal hashes and share a bucket, in parts if they are over a limit together. A row
    larger than the limit, however long, is a shard by itself. An empty table gives an empty one; other columns are not looked at.
    """
    rows = stored(
        docs.select(
            docs["doc_id"].alias("key"),
            n_bytes(docs["text"]).alias("n_bytes"),
            row_hash(docs["doc_id"], docs["text"]).alias("hash"),
        ),
        "hashes",
    )
    entries = directory(rows, max_bytes, max_rows)
    return assign(rows, entries, max_bytes, max_rows).select(
        "key", "n_bytes", "depth", "prefix", "part", "shard_bytes"
    )


def write_shards(
    docs: DataFrame, path: str, max_bytes: int = MAX_BYTES, max_rows: int = MAX_ROWS
) -> None:
    """Write all columns of `docs`, one folder per shard, below `path`.

    Texts move once, to the task of their shard; the directory is joined as a small table. It is
    made from a stored table of hashes and sizes, so each level of it reads no text.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        n_bytes(docs["text"]).alias("n_bytes"),
        row_hash(docs["doc_id"], docs["text"]).alias("hash"),
    )
    hashes = stored(rows.select("hash", "n_bytes"), "hashes")
    entries = directory(hashes, max_bytes, max_rows)
    name = F.concat_ws("-", F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")), "depth", "part")
    shard = fresh(docs, "_shard")
    placed = assign(rows, entries, max_bytes, max_rows).select("row.*", name.alias(shard))
    placed.repartition(shard).write.partitionBy(shard).parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of shard_rows, from files of write_shards alone; schema is that of its `docs`.

    Depth, prefix and part are those of the folder in which a row lies, shard_bytes is the sum over
    all rows found there.
    """
    shard = fresh(spark.createDataFrame([], schema), "_shard")
    files = spark.read.schema(StructType([*schema, StructField(shard, StringType())])).parquet(path)
    rows = files.select(
        files["doc_id"].alias("key"), n_bytes(files["text"]).alias("n_bytes"), F.col(shard).alias("shard")
    )
    sums = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    bits, depth, part = (F.split_part("shard", F.lit("-"), F.lit(i)) for i in (1, 2, 3))
    return rows.join(sums, "shard").select(
        "key", "n_bytes", depth.cast("int").alias("depth"),
        F.coalesce(F.conv(bits, 2, 10).cast("long"), F.lit(0).cast("long")).alias("prefix"),
        part.cast("long").alias("part"), "shard_bytes",
    )
