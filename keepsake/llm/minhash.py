"""Near-duplicate texts by fast similarity sketching, banding and exact confirmation.

A sketch has 128 coordinates. In round i every shingle of a text is thrown into a hashed bin with a
hashed value, and bins still empty keep the smallest; from round 128 on a round's bin is fixed, so
every coordinate is filled after 256 rounds at most, and after one or two for most texts. Two texts
agree in a coordinate with the probability that is their similarity.

Texts with equal words are one class from the start. Classes that agree in a band of coordinates are
candidates. Within a band's bucket, sketches are compared in blocks of bounded size, and pairs whose
sketches are far from the threshold go no further. Of the others, a first round confirms only the
pairs that are likely to join the bucket together (each class with its closest, and with the
bucket's most central class), so a group of thousands of near copies costs about one confirmation
per member. A second round confirms all pairs that are still apart: the shingle sets of the classes
that have such a pair are sent to the bucket's block, where the pairs are tried without ever
becoming rows, each in the first band that it shares. No link between components is lost. Links are
confirmed on full shingle sets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.llm import text as tx
from keepsake.llm.components import components
from keepsake.llm.tables import stored

WIDTH = 5
PERCENT = 75
COORDINATES = 128
BANDS = 32
# Sketches that agree in fewer of their coordinates than this are taken to be below the threshold.
# At the threshold itself a sketch agrees in 0.75, with a deviation of 0.038.
LEAST_AGREEMENT = 0.58
# Classes of one bucket that are compared in one go.
BLOCK = 1024
# The most ids for which documents are looked up by a broadcast.
BROADCAST_IDS = 500_000

_ROWS = COORDINATES // BANDS
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_BREAK = re.compile(r"[\x20\x09-\x0D]+")
_UPPER = {c: c + 32 for c in range(65, 91)}


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of coordinates for each text's shingle hashes; all ones for a text without any."""
    n = len(bounds) - 1
    t = np.uint64(COORDINATES)
    out = np.full((n, COORDINATES), _EMPTY)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    for i in range(2 * COORDINATES):
        if not len(hashes):
            break
        step = np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64))
        value = tx.mix(hashes + step)
        if i < COORDINATES:
            at = owner * COORDINATES + (value % t).astype(np.int64)
        else:
            at = owner * COORDINATES + (i - COORDINATES)
        value = (value >> np.uint64(8)) | (np.uint64(i) << np.uint64(56))
        # Values carry their round on top, so a later round never displaces an earlier one's.
        np.minimum.at(out.reshape(-1), at, value)
        open_ = (out == _EMPTY).any(axis=1)[owner]
        if not open_.all():
            hashes, owner = hashes[open_], owner[open_]
    return out


def _fingerprint(text: str) -> bytes:
    words = " ".join(w for w in _BREAK.split(text.translate(_UPPER)) if w)
    return hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    salt = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for batch in batches:
        texts = batch["text"].fillna("").tolist()
        for a, b in tx.runs(texts):
            hashes, bounds = tx.shingle_hashes(texts[a:b], WIDTH)
            coordinates = sketches(hashes, bounds)
            keys = np.zeros((b - a, BANDS), np.uint64)
            for r in range(_ROWS):
                keys = tx.mix(keys * np.uint64(31) + coordinates[:, r::_ROWS] + np.uint64(r))
            keys = tx.mix(keys + salt).view(np.int64)
            sizes = [len(np.unique(hashes[i:j])) for i, j in zip(bounds, bounds[1:])]
            short = (coordinates & np.uint64(0xFFFFFFFF)).astype("<u4")
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[a:b],
                    "known": batch["known"].iloc[a:b],
                    "class": [_fingerprint(t) for t in texts[a:b]],
                    "n_shingles": np.array(sizes, np.int64),
                    "sketch": [s.tobytes() for s in short],
                    "bands": list(keys),
                }
            )


def signed(docs: DataFrame) -> DataFrame:
    """(key, class, n_shingles, sketch, bands) of every row, stored.

    class is a 128-bit digest of the text's lower-cased words.
    """
    rows = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("doc_id"),
        docs["doc_id"].isNotNull().alias("known"),
        docs["text"].cast("string").alias("text"),
    )
    found = rows.mapInPandas(
        _sign,
        "doc_id long, known boolean, class binary, n_shingles long, sketch binary, "
        "bands array<long>",
    )
    key = F.when(F.col("known"), F.col("doc_id")).alias("key")
    return stored(found.select(key, "class", "n_shingles", "sketch", "bands"), "sketches")


def _candidates(classes: DataFrame) -> DataFrame:
    """(nth, band, i, j, part, class, sketch): the classes of every bucket that has several, dealt
    to pairs of blocks; part is 0 for a class of block i and 1 for one of another block j. nth is
    the band's number."""
    bands = classes.select("class", F.posexplode("bands").alias("nth", "band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = bands.join(shared, "band")
    n_blocks = F.ceil(F.col("size") / BLOCK)
    block = F.pmod(F.xxhash64("class"), n_blocks)
    dealt = members.select("class", "nth", "band", block.alias("own"), F.explode(
        F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("other"))
    cell = dealt.select(
        "class", "nth", "band",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("part"),
    )
    return cell.join(classes.select("class", "sketch"), "class")


def _by_cell(batches: Iterator[pd.DataFrame], work) -> Iterator[pd.DataFrame]:
    """work(cell) for rows that arrive cell by cell. Cells are at most two blocks large."""
    held = None
    for batch in batches:
        batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
        keys = batch[["band", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        found = [work(_Cell(batch, a, b)) for a, b in zip(starts, starts[1:])]
        if any(f is not None for f in found):
            yield pd.concat([f for f in found if f is not None], ignore_index=True)
        held = batch.iloc[starts[-1] :]
    if held is not None and len(held):
        found = work(_Cell(held, 0, len(held)))
        if found is not None:
            yield found


class _Cell:
    """Rows a to b of a batch: one cell, with how many coordinates its pairs agree in."""

    def __init__(self, batch: pd.DataFrame, a: int, b: int):
        self.rows = batch.iloc[a:b]
        n = b - a
        self.sketch = np.frombuffer(b"".join(self.rows["sketch"]), "<u4").reshape(n, COORDINATES)
        self.across = self.rows["i"].iloc[0] != self.rows["j"].iloc[0]
        part = self.rows["part"].to_numpy()
        self.left = np.flatnonzero(part == 0) if self.across else np.arange(n)
        self.right = np.flatnonzero(part == 1) if self.across else self.left
        self.equal = np.empty((len(self.left), len(self.right)), np.int16)
        other = self.sketch[self.right]
        for k, x in enumerate(self.left):
            self.equal[k] = (other == self.sketch[x]).sum(axis=1)
        if not self.across:
            np.fill_diagonal(self.equal, -1)
        self.close = self.equal >= LEAST_AGREEMENT * COORDINATES

    def likely(self) -> pd.DataFrame | None:
        """Pairs that are likely to join the cell together."""
        if not self.close.any():
            return None
        central = int(np.where(self.close, self.equal, 0).sum(axis=0, dtype=np.int64).argmax())
        every = np.arange(len(self.left))
        x = np.concatenate((every, every))
        y = np.concatenate((self.equal.argmax(axis=1), np.full(len(every), central)))
        if self.across:
            x = np.concatenate((x, self.equal.argmax(axis=0)))
            y = np.concatenate((y, np.arange(len(self.right))))
        good = self.close[x, y]
        names = self.rows["class"].to_numpy()
        p, q = names[self.left[x[good]]], names[self.right[y[good]]]
        pairs = sorted({(min(a, b), max(a, b)) for a, b in zip(p, q)})
        return pd.DataFrame(pairs, columns=["a", "b"])

    def apart(self) -> tuple[np.ndarray, np.ndarray]:
        """Close pairs (row, row) with different roots whose first shared band is this one."""
        x, y = np.nonzero(self.close if self.across else np.triu(self.close))
        x, y = self.left[x], self.right[y]
        root, nth = self.rows["root"].to_numpy(), int(self.rows["nth"].iloc[0])
        different = root[x] != root[y]
        x, y = x[different], y[different]
        first = np.zeros(len(x), bool)
        for a in range(0, len(x), 1 << 14):
            s = slice(a, a + (1 << 14))
            same = (self.sketch[x[s]] == self.sketch[y[s]]).reshape(-1, BANDS, _ROWS).all(axis=2)
            first[s] = same.argmax(axis=1) == nth
        return x[first], y[first]

    def open_rows(self) -> pd.DataFrame | None:
        """The rows that have a pair still to be tried here."""
        x, y = self.apart()
        return self.rows.iloc[np.unique(np.concatenate((x, y)))] if len(x) else None

    def links(self, percent: int) -> pd.DataFrame | None:
        """Of the pairs still apart, one confirmed link for each two roots that have one."""
        sets = [np.frombuffer(s, np.uint64) for s in self.rows["shingles"]]
        names, root = self.rows["class"].to_numpy(), self.rows["root"].to_numpy()
        found = {}
        for x, y in zip(*self.apart()):
            roots = (min(root[x], root[y]), max(root[x], root[y]))
            if roots not in found and _similar(sets[x], sets[y], percent):
                found[roots] = (min(names[x], names[y]), max(names[x], names[y]))
        return pd.DataFrame(list(found.values()), columns=["a", "b"]) if found else None


_CELL = "nth int, band long, i long, j long, part int, class binary, sketch binary, root binary"


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _in_cells(rows: DataFrame, work, schema: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "band", "i", "j").sortWithinPartitions("band", "i", "j")
    return dealt.mapInPandas(lambda batches: _by_cell(batches, work), schema)


def _shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].fillna("").tolist()
        for a, b in tx.runs(texts):
            hashes, bounds = tx.shingle_hashes(texts[a:b], WIDTH)
            sets = [np.unique(hashes[i:j]).tobytes() for i, j in zip(bounds, bounds[1:])]
            names = [_fingerprint(t) for t in texts[a:b]]
            yield pd.DataFrame({"class": names, "shingles": sets})


def _similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """For sorted sets: is the intersection at least `percent` % of the union?"""
    both = np.sort(np.concatenate((p, q)), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(p) + len(q) - shared)


def _linked(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        good = [
            _similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
            for x, y in zip(batch["x"], batch["y"])
        ]
        yield batch.loc[good, ["a", "b"]]


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    x = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return joined.mapInPandas(lambda batches: _linked(batches, percent), "a binary, b binary")


def _sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, shingles) of the wanted classes, computed again from one text of each."""
    ids = rows.join(wanted, "class").groupBy("class").agg(
        F.min("key").alias("key"), F.max(F.col("key").isNull()).alias("nameless")
    )
    ids = stored(ids, "wanted")
    found = ids.agg(F.count("*"), F.max("nameless")).first()
    keys = ids.select("key").distinct()
    if found[0] <= BROADCAST_IDS:
        keys = F.broadcast(keys)
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    )
    chosen = texts.join(keys, F.col("doc_id") == F.col("key"), "left_semi")
    if found[1]:  # classes of rows without an id
        chosen = chosen.union(texts.where("doc_id is null"))
    sets = chosen.mapInPandas(_shingle_sets, "class binary, shingles binary")
    sets = sets.join(ids.select("class"), "class", "left_semi")
    return stored(sets.dropDuplicates(["class"]), "shingles")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, class, n_shingles, component_id, kept) for every row; key is its doc_id, class a digest
    of its words.

    Words are lower-cased (A-Z) runs without white space; a text's set has its distinct runs of five
    words, or all of its words as one run if it has fewer. Rows link if their sets' intersection is
    at least `percent` % of their union. component_id is the smallest id that links lead to; rows
    without an id follow their component and count as smallest in none, so it is null only where no
    row of the component has an id. kept marks rows whose id is their component's. A text that is
    null or without words links with nothing and keeps its own id. Rows that repeat an id get a row
    each. An empty table gives an empty one; other columns are not looked at.
    """
    rows = signed(docs)
    worded = rows.where("n_shingles > 0")
    classes = worded.groupBy("class").agg(
        F.first("sketch").alias("sketch"), F.first("bands").alias("bands")
    )
    candidates = stored(_candidates(classes), "candidates")
    likely = _in_cells(candidates, _Cell.likely, "a binary, b binary").distinct()
    wanted = candidates.select("class").distinct()
    sets = _sets(docs, worded, wanted)
    roots = stored(components(_confirmed(likely, sets, percent)), "roots")
    known = candidates.join(roots.toDF("class", "root"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    still = stored(_in_cells(known.select(_names(_CELL)), _Cell.open_rows, _CELL), "open")
    second = _in_cells(
        still.join(sets, "class"), lambda cell: cell.links(percent), "a binary, b binary"
    )
    second = stored(second, "links")
    if not second.isEmpty():
        joined = second.union(roots.toDF("a", "b"))
        roots = stored(components(joined), "roots")
    root = F.coalesce("root", "class")
    placed = worded.select("key", "class", "n_shingles").join(
        roots.toDF("class", "root"), "class", "left"
    ).select("key", "class", "n_shingles", root.alias("root"))
    least = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    columns = ["key", "class", "n_shingles", "component_id"]
    # Rows without words need no component, and no join in which they would all meet.
    wordless = rows.where("n_shingles = 0").withColumn("component_id", F.col("key"))
    out = placed.join(least, "root").select(*columns).union(wordless.select(*columns))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("key")))


def representatives(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, with all of their columns, that stay: one of each component.

    Rows that repeat an id count as one document: of those that stay, the first by text is taken.
    Of rows without an id all stay whose component has no row with one, and all without words.
    """
    found = near_duplicates(docs, percent)
    gone = found.where("not kept and key is not null").select("key").distinct()
    repeated = (
        found.where("kept and key is not null").groupBy("key").count().where("count > 1")
        .select("key")
    )
    tags = stored(gone.withColumn("gone", F.lit(True)).union(
        repeated.join(gone, "key", "left_anti").withColumn("gone", F.lit(False))), "gone")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs["doc_id"].alias("key"))
    if tags.count() <= BROADCAST_IDS:
        tags = F.broadcast(tags)
    named = rows.where("key is not null").join(tags, "key", "left")
    single = named.where("gone is null").select("row.*")
    again = named.where("not gone").groupBy("key").agg(
        F.min_by("row", F.struct("row.text")).alias("row")
    )
    # Rows without an id are told apart by their words.
    nameless = rows.where("key is null").select("row", _class(F.col("row.text")).alias("class"))
    linked = found.where("not kept and key is null").select("class").distinct()
    nameless = nameless.join(linked, "class", "left_anti")
    return single.unionByName(again.select("row.*")).unionByName(nameless.select("row.*"))


def _class(text: Column) -> Column:
    @F.pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(_fingerprint)

    return digest(text.cast("string"))
