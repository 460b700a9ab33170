"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A hash rotates a vector pseudo-randomly (signs and Hadamard transform, three times) and takes the
nearest of the 2d axis directions. A table's bucket is made of two such hashes; a vector is stored
in its own bucket of each table and also probes the likeliest other ones, those reached by taking
the second-best direction in one of the hashes. Candidate pairs are verified by cosine in double
precision, within a label only.

Equal vectors are one class from the start. A bucket is compared in blocks of bounded size, by
matrix products, in as many tasks as it has pairs of blocks. Each linked pair is counted in the one
bucket that is the first where it meets, so links are exact counts without a list of all pairs; of
each block only a spanning forest of links leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.components import components
from keepsake.llm.tables import stored

COSINE = 0.98
# Directions that name a bucket, and tables of buckets, by the rows of the largest label: another
# direction where labels are large keeps chance hits few, and more tables keep the recall. With
# either, all of 20,000 pairs at a cosine of 0.98 with 64 components meet, and of 4,000 with 256.
SIZES = ((1 << 20, 3, 12), (1 << 62, 4, 24))
ROTATIONS = 3
# Vectors of one bucket that are compared in one go.
BLOCK = 1024
SEED = 11

_SIDE = 1 << 12  # more than twice any usual dimension: a hash's number of directions


def hashing(rows: int) -> tuple[int, int]:
    """(hashes, tables) for labels of so many rows."""
    return next((hashes, tables) for most, hashes, tables in SIZES if rows <= most)


@cache
def _signs(size: int, hashes: int, tables: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return rng.choice(np.array([-1.0, 1.0]), (tables, hashes, ROTATIONS, size))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        x = x.reshape(n, size)
        half *= 2
    return x / np.sqrt(size)


def bucket_codes(vectors: np.ndarray, hashes: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Own buckets (n, tables) and probed buckets (n, tables, hashes) of unit vectors."""
    n, d = vectors.shape
    size = 1 << max(d - 1, 1).bit_length()
    padded = np.zeros((n, size))
    padded[:, :d] = vectors
    own = np.zeros((n, tables), np.int64)
    probes = np.zeros((n, tables, hashes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, second = np.zeros((hashes, n), np.int64), np.zeros((hashes, n), np.int64)
        for h in range(hashes):
            x = padded
            for r in range(ROTATIONS):
                x = _hadamard(x * _signs(size, hashes, tables)[t, h, r])
            far = np.abs(x)
            at = far.argmax(axis=1)
            best[h] = 2 * at + (x[rows, at] < 0)
            far[rows, at] = -1
            at = far.argmax(axis=1)
            second[h] = 2 * at + (x[rows, at] < 0)
        own[:, t] = _key(best, t)
        for h in range(hashes):
            other = best.copy()
            other[h] = second[h]
            probes[:, t, h] = _key(other, t)
    return own, probes


def _key(directions: np.ndarray, table: int) -> np.ndarray:
    out = np.full(directions.shape[1], table, np.int64)
    for row in directions:
        out = out * _SIDE + row
    return out


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hash(
    batches: Iterator[pd.DataFrame], hashes: int, tables: int
) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes = batch["vector"].map(len)
        for _, part in batch.groupby(sizes):
            x = _unit(part["vector"].tolist())
            own, probes = bucket_codes(x, hashes, tables)
            yield pd.DataFrame(
                {
                    "class": part["class"].to_numpy(), "label": part["label"].to_numpy(),
                    "copies": part["copies"].to_numpy(), "own": list(own),
                    "probes": list(probes.reshape(len(x), -1)),
                    "unit": [row.tobytes() for row in x],
                }
            )


def _cells_of(batches: Iterator[pd.DataFrame], work) -> Iterator[pd.DataFrame]:
    """Apply work(rows of one cell) to rows that arrive cell by cell."""
    held = None
    for batch in batches:
        batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
        keys = batch[["label", "size", "bucket", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        for a, b in zip(starts, starts[1:]):
            yield from work(batch.iloc[a:b])
        held = batch.iloc[starts[-1] :]
    if held is not None and len(held):
        yield from work(held)


def _links(cell: pd.DataFrame, cosine: float) -> Iterator[pd.DataFrame]:
    """Of one cell: what each class gains in links, and a spanning forest of the links."""
    if len(cell) < 2:
        return
    bucket, across = cell["bucket"].iloc[0], cell["i"].iloc[0] != cell["j"].iloc[0]
    names, part = cell["class"].to_numpy(), cell["part"].to_numpy()
    left = np.flatnonzero(part == 0) if across else np.arange(len(cell))
    right = np.flatnonzero(part == 1) if across else left
    if not len(left) or not len(right):
        return
    x = np.frombuffer(b"".join(cell["unit"]), np.float64).reshape(len(cell), -1)
    found = x[left] @ x[right].T >= cosine
    if not across:
        found &= np.tri(len(left), k=-1, dtype=bool)
    p, q = np.nonzero(found)
    p, q = left[p], right[q]
    distinct = names[p] != names[q]
    p, q = p[distinct], q[distinct]
    if not len(p):
        return
    own = np.stack(cell["own"])
    probes = np.stack(cell["probes"]).reshape(*own.shape, -1)
    keep = np.zeros(len(p), bool)
    for a in range(0, len(p), 1 << 16):
        s = slice(a, a + (1 << 16))
        keep[s] = _first_meeting(own, probes, names, p[s], q[s]) == bucket
    p, q = p[keep], q[keep]
    if not len(p):
        return
    copies = cell["copies"].to_numpy()
    gain = np.bincount(p, copies[q], len(cell)) + np.bincount(q, copies[p], len(cell))
    some = np.flatnonzero(gain)
    yield pd.DataFrame({"a": names[some], "b": names[some], "gain": gain[some].astype(np.int64)})
    edges = _forest(len(cell), p, q)
    yield pd.DataFrame({"a": names[p[edges]], "b": names[q[edges]], "gain": 0})


def _first_meeting(own, probes, names, p, q) -> np.ndarray:
    """The one bucket in which a pair is counted: in the first table where either vector's own
    bucket is the other's or is probed by the other; there the shared own bucket, else the own
    bucket of the smaller class if the other probes it, else that of the larger."""
    swap = names[p] > names[q]
    p, q = np.where(swap, q, p), np.where(swap, p, q)
    out = np.full(len(p), -1, np.int64)
    for t in range(own.shape[1] - 1, -1, -1):
        a, b = own[p, t], own[q, t]
        in_q = (probes[q, t] == a[:, None]).any(axis=1)
        in_p = (probes[p, t] == b[:, None]).any(axis=1)
        out = np.where((a == b) | in_q, a, np.where(in_p, b, out))
    return out


def _forest(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Numbers of edges that keep the graph of n nodes as connected as all edges do."""
    root = np.arange(n)
    chosen = []
    while True:
        a, b = root[p], root[q]
        open_ = np.flatnonzero(a != b)
        if not len(open_):
            return np.array(sorted(set(chosen)), np.int64)
        # Each component takes one edge to a component with a smaller root, if it has any.
        high = np.maximum(a[open_], b[open_])
        nodes, first = np.unique(high, return_index=True)
        chosen += open_[first].tolist()
        target = np.arange(n)
        target[nodes] = np.minimum(a[open_], b[open_])[first]
        while not np.array_equal(target, again := target[target]):
            target = again
        root = target[root]


def linked_vectors(
    table: DataFrame,
    cosine: float = COSINE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row; key is its vec_id.

    Rows are compared when their labels are equal and not null, and their vectors have as many
    components. n_links counts the other rows linked directly, equal vectors included; component_id
    is the smallest id that links lead to, the row's own if there is none. A vector that is null,
    empty, all zero or has a null or non-finite component links with nothing; so does a row without
    a label or id. Repeated rows link with each other. An empty table gives an empty one.
    """
    rows = table.select(
        table[vec_id].cast("long").alias("key"),
        table[label].cast("string").alias("label"),
        table[embedding].cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    sound = (
        F.col("label").isNotNull() & F.col("key").isNotNull() & F.col("vector").isNotNull()
        & finite & F.exists("vector", lambda x: x != 0)
    )
    text = F.concat_ws("|", "label", F.to_json(F.transform("vector", lambda x: x + F.lit(0.0))))
    rows = stored(
        rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
        .withColumn("print", F.when(F.col("sound"), F.sha2(text, 256)))
        .select("key", "label", "print", F.when(F.col("sound"), F.col("vector")).alias("vector")),
        "vectors",
    )
    # A class is named by its smallest id; a repeated id with two vectors is named with its print.
    prints = rows.where("print is not null")
    classes = prints.groupBy("print").agg(
        F.min("key").alias("least"), F.count("*").alias("copies"),
        F.first("label").alias("label"), F.first("vector").alias("vector"),
    )
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    hashes, tables = hashing(most)
    hashed = stored(
        classes.select(F.col("print").alias("class"), "label", "copies", "vector").mapInPandas(
            partial(_hash, hashes=hashes, tables=tables),
            "class string, label string, copies long, own array<long>, probes array<long>, "
            "unit binary",
        ),
        "hashed",
    )
    places = F.array_distinct(F.concat("own", "probes"))
    entries = hashed.select(
        "class", "label", F.length("unit").alias("size"), F.explode(places).alias("bucket"),
    )
    sizes = entries.groupBy("label", "size", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = entries.join(sizes, ["label", "size", "bucket"])
    n_blocks = F.ceil(F.col("n") / BLOCK)
    dealt = members.withColumn("at", F.pmod(F.xxhash64("class"), n_blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1))
    )
    cells = dealt.select(
        "class", "label", "size", "bucket",
        F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
        F.when(F.col("at") <= F.col("other"), 0).otherwise(1).alias("part"),
    ).join(hashed.select("class", "copies", "own", "probes", "unit"), "class")
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["label", "size", "bucket", "i", "j"]
    found = cells.repartition(n, *keys).sortWithinPartitions(*keys).mapInPandas(
        lambda batches: _cells_of(batches, lambda cell: _links(cell, cosine)),
        "a string, b string, gain long",
    )
    found = stored(found, "found")
    gains = found.where("a = b").groupBy("a").agg(F.sum("gain").alias("gain"))
    roots = stored(components(found.where("a <> b").select("a", "b")), "roots")
    named = (
        classes.select("print", "least", "copies")
        .join(gains.withColumnRenamed("a", "print"), "print", "left")
        .join(roots.toDF("print", "root"), "print", "left")
        .withColumn("root", F.coalesce("root", "print"))
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(smallest, "root").select(
        "print", (F.coalesce("gain", F.lit(0)) + F.col("copies") - 1).alias("links"), "component"
    )
    # Rows without a sound vector have no print and would meet in one task.
    out = rows.where("print IS NOT NULL").select("key", "print").join(named, "print")
    out = out.select("key", "links", "component").union(
        rows.where("print IS NULL").select(
            "key", F.lit(0).cast("long").alias("links"), F.lit(None).cast("long").alias("component")
        )
    )
    component = F.coalesce("component", "key")
    return out.select(
        "key", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("key")).alias("kept"),
    )
