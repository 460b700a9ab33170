"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of five words are a candidate pair. Tiling then
marks the longest common run of words that covers no marked word on either side, again and again,
down to five words; running Karp-Rabin hashes find runs of a length in both. Tiles may stand in any
order, so reordered passages count. A document is contaminated by an item if tiles cover enough of
the item's words.

Candidates: a bitmap of fixed size marks the hashes of all items' runs, and each task drops the
documents that hit none. What is left is joined with the items on the full hash. The benchmark may
be of any size: only the bitmap is sent to every task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.llm import text as tx
from keepsake.llm.tables import stored

SEED_WORDS = 5
# The share of an item's words that makes a document contaminated.
COVERAGE = 0.5
# Length at which the search for runs starts, if both texts are that long.
_FIRST_LENGTH = 40
_BITMAP_BITS = 22
# A hash marks two places: its low bits, and those from this bit on.
_SECOND = 26
_BASE, _MODULUS = 1_000_003, (1 << 61) - 1
_BREAK = re.compile(r"[\x20\x09-\x0D]+")
_UPPER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return [w for w in _BREAK.split((text or "").translate(_UPPER)) if w]


def _rolling(tokens: list[int], marked: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(hash, start) of every run of `length` unmarked tokens, by running Karp-Rabin."""
    top = pow(_BASE, length - 1, _MODULUS)
    value = size = 0
    for i, token in enumerate(tokens):
        if marked[i]:
            value = size = 0
            continue
        if size == length:
            value = (value - tokens[i - length] * top) % _MODULUS
            size -= 1
        value = (value * _BASE + token) % _MODULUS
        size += 1
        if size == length:
            yield value, i - length + 1


def tiles(item: list[str], doc: list[str], least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """(start in item, start in doc, length) of the tiles, longest first.

    An item with fewer than `least` words is tiled as a whole or not at all. Among runs of equal
    length the first in the item and then in the document is taken.
    """
    least = min(least, len(item))
    if not least:
        return []
    number: dict[str, int] = {}
    p = [number.setdefault(w, len(number) + 1) for w in item]
    t = [number.get(w, 0) for w in doc]
    # A word that the item doesn't have can be in no tile.
    p_marked, t_marked = [False] * len(p), [x == 0 for x in t]
    found: list[tuple[int, int, int]] = []
    length = max(least, min(_FIRST_LENGTH, len(p), len(t)))
    while True:
        longest, matches = _matches(p, t, p_marked, t_marked, length)
        if longest > 2 * length:
            length = longest
            continue
        for size, a, b in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if any(p_marked[a : a + size]) or any(t_marked[b : b + size]):
                continue
            p_marked[a : a + size] = t_marked[b : b + size] = [True] * size
            found.append((a, b, size))
        if length == least:
            # Parts of matches that a longer tile cut into may still be long enough.
            if not any(m[0] >= least for m in _matches(p, t, p_marked, t_marked, least)[1]):
                return found
        elif length > 2 * least:
            length //= 2
        else:
            length = least


def _matches(p, t, p_marked, t_marked, length) -> tuple[int, list[tuple[int, int, int]]]:
    """The longest match's length, and all maximal matches (length, a, b) of at least `length`."""
    by_hash: dict[int, list[int]] = {}
    for value, a in _rolling(p, p_marked, length):
        by_hash.setdefault(value, []).append(a)
    longest, out, done = 0, [], {}
    for value, b in _rolling(t, t_marked, length) if by_hash else ():
        for a in by_hash.get(value, ()):
            if done.get(b - a, -1) >= b + length:  # inside a match already extended
                continue
            if p[a : a + length] != t[b : b + length]:
                continue
            n = length
            while (
                a + n < len(p) and b + n < len(t) and p[a + n] == t[b + n]
                and not p_marked[a + n] and not t_marked[b + n]
            ):
                n += 1
            done[b - a] = b + n
            longest = max(longest, n)
            out.append((n, a, b))
            if n > 2 * length:
                return n, out
    return longest, out


def _seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["item_text"].fillna("").tolist()
        hashes, bounds = tx.shingle_hashes(texts, SEED_WORDS)
        n = np.diff(bounds)
        yield pd.DataFrame(
            {
                "item": np.repeat(batch["item"].to_numpy(), n),
                "seed": hashes.view(np.int64),
                "n_words": np.repeat([len(words(t)) for t in texts], n),
            }
        )


def _hits(bitmap: np.ndarray, short: list[int]):
    """Documents that hit the bitmap, with the seeds that do."""
    mask = np.uint64((1 << _BITMAP_BITS) - 1)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            for a, b in tx.runs(texts):
                plain, bounds = tx.word_hashes(texts[a:b])
                seeds: list[list] = [[] for _ in range(b - a)]
                # Full seeds, and the whole runs that items of fewer words have.
                for width in [SEED_WORDS, *short]:
                    hashes, cuts = tx.run_hashes(plain, bounds, width, SEED_WORDS)
                    hit = np.flatnonzero(bitmap[(hashes & mask).astype(np.int64)])
                    second = (hashes[hit] >> np.uint64(_SECOND)) & mask
                    hit = hit[bitmap[second.astype(np.int64)]]
                    owner = np.searchsorted(cuts, hit, side="right") - 1
                    for i, h in zip(owner, hashes[hit].view(np.int64)):
                        seeds[i].append(h)
                keep = [i for i, s in enumerate(seeds) if s]
                if not keep:
                    continue
                part = batch.iloc[a:b].iloc[keep]
                yield part.assign(seeds=[np.unique(seeds[i]) for i in keep])

    return find


def _row(key: Column, text: Column) -> Column:
    """A digest of an id and a text: null for a null text, different for a null and an empty id."""
    size = F.coalesce(F.length(key), F.lit(-1)).cast("string")
    return F.md5(F.concat(size, F.lit("|"), F.coalesce(key, F.lit("")), F.lit("|"), text))


def _tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        item = [words(t) for t in batch["item_text"]]
        made = [tiles(p, words(t)) for p, t in zip(item, batch["text"])]
        covered = np.array([sum(x[2] for x in m) for m in made], np.int64)
        size = np.array([len(p) for p in item], np.int64)
        yield pd.DataFrame(
            {
                "row": batch["row"], "item": batch["item"], "n_tiles": [len(m) for m in made],
                "covered": covered, "coverage": covered / np.maximum(size, 1),
            }
        )


def tiled_pairs(docs: DataFrame, benchmark: DataFrame, least: float = 0.0) -> DataFrame:
    """(key, row, item, n_tiles, covered, coverage) of every document and item with a shared seed;
    of those that can't reach the coverage `least`, some are left out.

    Every five words in a row of a tile are a shared seed, so tiles cover at most five words for each
    place of the item that begins one. Pairs are counted by that before any text is joined to them.

    key is the doc_id and item the item_id, as texts; row numbers a document's text, by its digest.
    Words are lower-cased (A-Z) runs without white space. An item with fewer than five words has one
    seed, all of it; one without words, or null, has none, as has a null or empty document. Repeated
    texts are tiled once for each id. Other columns are not looked at.
    """
    items = stored(
        benchmark.select(
            benchmark["item_id"].cast("string").alias("item"),
            benchmark["text"].cast("string").alias("item_text"),
        ).where("item_text is not null"),
        "items",
    )
    seeds = items.mapInPandas(_seeds, "item string, seed long, n_words long")
    seeds = stored(seeds, "seeds")
    size = F.lit(1 << _BITMAP_BITS)
    both = F.array(F.pmod("seed", size), F.pmod(F.shiftrightunsigned("seed", _SECOND), size))
    bitmap = np.zeros(1 << _BITMAP_BITS, bool)
    bits = seeds.select(F.explode(both).alias("bit")).distinct().toPandas()["bit"].to_numpy()
    bitmap[bits] = True
    short = [r[0] for r in seeds.where(F.col("n_words") < SEED_WORDS).select("n_words")
             .distinct().collect()]
    texts = docs.select(
        docs["doc_id"].cast("string").alias("key"), docs["text"].cast("string").alias("text")
    ).where("text is not null")
    hit = texts.mapInPandas(_hits(bitmap, short), "key string, text string, seeds array<long>")
    hit = stored(hit.withColumn("row", _row(F.col("key"), F.col("text"))), "hits")
    places = seeds.groupBy("item", "seed").agg(
        F.count("*").alias("places"), F.max("n_words").alias("n_words")
    )
    found = hit.select("row", F.explode("seeds").alias("seed")).distinct().join(places, "seed")
    pairs = (
        found.groupBy("row", "item")
        .agg(F.sum("places").alias("places"), F.max("n_words").alias("n_words"))
        .where(SEED_WORDS * F.col("places") + 1e-6 >= least * F.col("n_words"))
        .select("row", "item")
    )
    once = hit.dropDuplicates(["row"]).select("row", "key", "text")
    joined = pairs.join(once.select("row", "text"), "row").join(items, "item")
    schema = "row string, item string, n_tiles long, covered long, coverage double"
    tiled = joined.mapInPandas(_tile, schema)
    return once.select("key", "row").join(tiled, "row")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that items are found in: (key, item, coverage, n_tiles, n_items).

    One row per doc_id (as text; null is an id too) with at least one item whose words are covered
    to `coverage` or more: the item with the highest coverage, the first by id among ties, and the
    number of such items.
    """
    pairs = tiled_pairs(docs, benchmark, coverage).where(F.col("coverage") >= coverage)
    best = F.min(F.struct((-F.col("coverage")).alias("least"), F.length("item").alias("size"),
                          "item", "coverage", "n_tiles"))
    return (
        pairs.groupBy("key")
        .agg(best.alias("best"), F.count_distinct("item").alias("n_items"))
        .select("key", "best.item", "best.coverage", "best.n_tiles", "n_items")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of `docs`, with all of their columns, that no item is found in.

    Rows that share an id are one document and go together; rows without an id are judged each by
    its own text. A row with neither id nor text stays.
    """

    def tag(key: Column, row: Column) -> Column:
        return F.coalesce(F.concat(F.lit("id "), key), F.concat(F.lit("text "), row))

    found = tiled_pairs(docs, benchmark, coverage).where(F.col("coverage") >= coverage)
    gone = found.select(tag(F.col("key"), F.col("row")).alias("tag")).distinct()
    gone = stored(gone, "contaminated")
    key, text = docs["doc_id"].cast("string"), docs["text"].cast("string")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        tag(key, _row(key, text)).alias("tag"),
    )
    return rows.join(gone, "tag", "left_anti").select("row.*")
