"""Ranked lexical search: MaxScore whose bounds also know pairs of terms.

`build_index` reads the texts once and writes blocks: for every term that a query may use, the
block's documents that hold it and how often. With the collection's counts these become impacts,
and each block gets, for each term, its greatest impact, and for chosen pairs of terms the greatest
sum of both impacts in a document that holds both. `search` then goes through the blocks. A query's
terms that no document could reach the ten best with, by these bounds, only complete the scores of
documents that other terms have found; a pair's joint maximum is below the sum of its terms' maxima
where the two peak in different documents, so more terms become such, and more documents are
skipped. All scores are whole numbers.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepsake.llm import text as tx
from keepsake.llm.dealt import joined
from keepsake.llm.tables import stored

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
# Characters of text in an index block, and queries that are searched at once.
BLOCK = 1 << 22
QUERIES = 2000
TOP = 10

_RAW = "ids binary, known binary, sizes binary, starts binary, docs binary, counts binary"


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


def _is_term(codes: np.ndarray) -> np.ndarray:
    return (
        ((codes >= 48) & (codes <= 57)) | ((codes >= 97) & (codes <= 122)) | (codes >= 128)
    )


def _term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' terms, and where each text's terms begin."""
    codes, bounds = tx.code_points(texts)
    codes = tx.lower_ascii(codes)
    starts, ends = tx.spans(_is_term(codes))
    return tx.Rolling(codes).hashes(starts, ends), np.searchsorted(starts, bounds)


@dataclass
class Vocabulary:
    """The queries' terms: their hashes in ascending order, and each query's places in it."""

    hashes: np.ndarray
    queries: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None]) -> Vocabulary:
        found = [sorted(set(terms_of(t))) for t in texts]
        words = sorted({w for own in found for w in own})
        hashes = _term_hashes(words)[0] if words else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        place = dict(zip((words[i] for i in order), range(len(words))))
        return cls(hashes[order], [np.array([place[w] for w in own], int) for own in found])


def build_index(docs: DataFrame, vocabulary: Vocabulary, block: int = BLOCK) -> DataFrame:
    """Blocks of postings, in a table: a row for about `block` characters of text.

    ids, known and sizes: each document's id, if it has one, and number of terms. docs and counts
    are the postings of all terms after one another, starts where each term's begin.
    """

    def blocks(batches):
        for batch in batches:
            texts = batch["text"].tolist()
            ids, known = batch["doc_id"].to_numpy(np.int64), batch["known"].to_numpy(bool)
            for a, b in tx.runs(texts, block):
                terms, bounds = _term_hashes(texts[a:b])
                size = np.diff(bounds)
                place = np.searchsorted(vocabulary.hashes, terms)
                place[place == len(vocabulary.hashes)] = 0
                at = np.flatnonzero(vocabulary.hashes[place] == terms) if len(vocabulary.hashes) else []
                owner = np.repeat(np.arange(b - a), size)[at]
                key, counts = np.unique(place[at] * (b - a) + owner, return_counts=True)
                starts = np.searchsorted(key, np.arange(len(vocabulary.hashes) + 1) * (b - a))
                arrays = (
                    ids[a:b].astype("<i8"), known[a:b].astype("u1"), size.astype("<i8"),
                    starts.astype("<u4"), (key % (b - a)).astype("<u4"), counts.astype("<u4"),
                )
                yield pd.DataFrame([[x.tobytes() for x in arrays]], columns=_names(_RAW))

    sent = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("doc_id"),
        docs["doc_id"].isNotNull().alias("known"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    return stored(sent.mapInPandas(blocks, _RAW), "postings")


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


@dataclass
class Statistics:
    """N, L, and each term's weight."""

    documents: int
    terms: int
    weights: np.ndarray

    @classmethod
    def of(cls, blocks: DataFrame, vocabulary: Vocabulary) -> Statistics:
        """From one sum for each term of the queries; no term of the texts reaches the driver."""

        def sums(batches):
            for batch in batches:
                for row in batch.itertuples():
                    size = np.frombuffer(row.sizes, "<i8")
                    held = np.diff(np.frombuffer(row.starts, "<u4").astype(np.int64))
                    used = np.flatnonzero(held)
                    n = np.concatenate(([(size > 0).sum(), size.sum()], held[used]))
                    yield pd.DataFrame({"what": np.concatenate(([-2, -1], used)), "n": n})

        found = blocks.select("sizes", "starts").mapInPandas(sums, "what long, n long")
        total = {r["what"]: r["n"] for r in found.groupBy("what").agg(F.sum("n").alias("n")).collect()}
        n = total.get(-2, 0)
        weights = [
            math.floor(1000 * math.log((2 * n + 2) / (2 * total.get(t, 0) + 1)))
            for t in range(len(vocabulary.hashes))
        ]
        return cls(n, total.get(-1, 0), np.array(weights, np.int64))

    def impacts(self, weight: np.ndarray, tf: np.ndarray, size: np.ndarray) -> np.ndarray:
        length = 100 - 90 + (90 * size * self.documents) // self.terms
        return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * length))


def _ranked(queries: list[np.ndarray], weights: np.ndarray) -> list[list[int]]:
    """Each query's terms, the least weight first."""
    return [sorted(own.tolist(), key=lambda t: (weights[t], t)) for own in queries]


def _pairs(ranked: list[list[int]]) -> np.ndarray:
    """Each query's terms two by two: (n, 2) distinct pairs."""
    found = {pair for terms in ranked for pair in zip(terms[::2], terms[1::2])}
    return np.array(sorted(found), int).reshape(-1, 2)


_INDEX = "ids binary, known binary, starts binary, docs binary, impacts binary, most binary, joint binary"


def with_impacts(blocks: DataFrame, statistics: Statistics, pairs: np.ndarray) -> DataFrame:
    """The index: blocks with impacts, each term's greatest one (most), and of each pair the
    greatest sum in a document that holds both (joint; 0 if none does)."""

    def weigh(batches):
        for batch in batches:
            for row in batch.itertuples():
                size = np.frombuffer(row.sizes, "<i8")
                starts = np.frombuffer(row.starts, "<u4").astype(np.int64)
                docs = np.frombuffer(row.docs, "<u4")
                tf = np.frombuffer(row.counts, "<u4").astype(np.int64)
                term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                impacts = np.zeros(0, np.int64)
                if len(docs):
                    impacts = statistics.impacts(statistics.weights[term], tf, size[docs])
                most = np.zeros(len(starts) - 1, np.int64)
                np.maximum.at(most, term, impacts)
                joint = _joint(pairs, starts, docs, impacts, len(size))
                arrays = [x.astype("<i8").tobytes() for x in (impacts, most, joint)]
                yield pd.DataFrame(
                    [[row.ids, row.known, row.starts, row.docs, *arrays]], columns=_names(_INDEX)
                )

    return stored(blocks.mapInPandas(weigh, _INDEX), "impacts")


def _joint(pairs, starts, docs, impacts, n_docs: int) -> np.ndarray:
    out = np.zeros(len(pairs), np.int64)
    row = np.zeros(n_docs, np.int64)
    last = -1
    for k, (a, b) in enumerate(pairs.tolist()):
        one, two = slice(starts[a], starts[a + 1]), slice(starts[b], starts[b + 1])
        if one.start == one.stop or two.start == two.stop:
            continue
        if a != last:
            row[:] = 0
            row[docs[one]] = impacts[one]
            last = a
        first = row[docs[two]]
        both = first > 0
        if both.any():
            out[k] = (first[both] + impacts[two][both]).max()
    return out


def search(
    docs: DataFrame, queries: DataFrame, top: int = TOP, at_once: int = QUERIES, block: int = BLOCK
) -> DataFrame:
    """(item, rank, key, score): each query's `top` best documents with a score above 0.

    docs has doc_id and text, queries has item_id and text; other columns are not looked at. Texts
    are searched whole. Queries are worked on `at_once` in a block of queries, each of which reads
    the texts once. Equal scores: ascending doc_id, null last. Rows that share a doc_id are
    documents of their own; so are queries that share an item_id, null included. Null and empty
    texts have no terms: such a document is never found and not counted, such a query finds nothing.
    Terms are compared by 64-bit hashes. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    asked = queries.select(
        queries["item_id"].cast("long").alias("item"), queries["text"].cast("string").alias("text")
    )
    ranked = asked.withColumn("n", F.monotonically_increasing_id())
    out = None
    # Queries come in blocks of bounded size; a benchmark of any size is as many of them.
    ranked = stored(ranked, "queries")
    for rows in _in_blocks(ranked, at_once):
        found = _search_block(docs, [r["item"] for r in rows], [r["text"] for r in rows], top, block)
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "item long, rank int, key long, score long")
    return out


def _in_blocks(ranked: DataFrame, at_once: int):
    after = -1
    while True:
        rows = ranked.where(F.col("n") > after).orderBy("n").limit(at_once).collect()
        if rows:
            yield rows
        if len(rows) < at_once:
            return
        after = rows[-1]["n"]


def _search_block(docs: DataFrame, items: list, texts: list, top: int, block: int) -> DataFrame:
    vocabulary = Vocabulary.of(texts)
    blocks = build_index(docs, vocabulary, block)
    statistics = Statistics.of(blocks, vocabulary)
    ranked = _ranked(vocabulary.queries, statistics.weights)
    pairs = _pairs(ranked)
    index = with_impacts(blocks, statistics, pairs)

    def find(batches):
        best = [_Best(top) for _ in items]
        for batch in batches:
            for row in batch.itertuples():
                own = _Block(row, pairs)
                for terms, kept in zip(ranked, best):
                    own.search(terms, kept)
        rows = [
            (n, items[n], i, s) for n, b in enumerate(best) for i, s in zip(b.ids, b.scores.tolist())
        ]
        found = pd.DataFrame(rows, columns=["query", "item", "key", "score"])
        yield found.astype({"item": "Int64", "key": "Int64"})

    found = index.mapInPandas(find, "query int, item long, key long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return found.select("item", "rank", "key", "score")


class _Best:
    """A task's best documents of one query so far."""

    def __init__(self, top: int):
        self.top, self.ids, self.scores = top, [], np.zeros(0, np.int64)

    @property
    def bar(self) -> int:
        """A document needs this score; one with an equal score may still win by its id."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, ids: np.ndarray, known: np.ndarray, scores: np.ndarray) -> None:
        mine = [(-s, not k, i) for s, k, i in zip(scores.tolist(), known.tolist(), ids.tolist())]
        mine += [(-s, i is None, i or 0) for s, i in zip(self.scores.tolist(), self.ids)]
        mine = sorted(mine)[: self.top]
        self.ids = [None if unknown else i for _, unknown, i in mine]
        self.scores = np.array([-s for s, _, _ in mine], np.int64)


class _Block:
    def __init__(self, row, pairs: np.ndarray):
        self.ids, self.known = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.known, "u1")
        self.starts = np.frombuffer(row.starts, "<u4").astype(np.int64)
        self.docs = np.frombuffer(row.docs, "<u4").astype(np.int64)
        self.impacts = np.frombuffer(row.impacts, "<i8")
        self.most = np.frombuffer(row.most, "<i8")
        joint = np.frombuffer(row.joint, "<i8")
        self.joint = dict(zip(map(tuple, pairs.tolist()), joint.tolist()))
        self.row = np.zeros(len(self.ids), np.int64)

    def bounds(self, terms: list[int]) -> list[int]:
        """How much the first 0, 1, 2... terms can give a document together.

        Two neighbours that are an indexed pair give at most their joint maximum, or the greater
        of their own where no document holds both.
        """
        out, k = [0], 0
        while k < len(terms):
            one = int(self.most[terms[k]])
            pair = self.joint.get((terms[k], terms[k + 1])) if k + 1 < len(terms) else None
            out.append(out[-1] + one)
            if pair is None:
                k += 1
                continue
            out.append(out[-2] + max(pair, one, int(self.most[terms[k + 1]])))
            k += 2
        return out

    def search(self, terms: list[int], best: _Best) -> None:
        bound, bar, row = self.bounds(terms), best.bar, self.row
        free = 0
        while free < len(terms) and bound[free + 1] < bar:
            free += 1
        if free == len(terms):
            return
        for t in terms[free:]:
            cut = slice(self.starts[t], self.starts[t + 1])
            row[self.docs[cut]] += self.impacts[cut]
        found = np.flatnonzero(row)
        have = row[found]
        row[found] = 0
        # The other terms, the greatest first; before each, documents that can't win any more go.
        for k in range(free, -1, -1):
            bar = max(bar, _nth(have, best.top))
            live = have + bound[k] >= bar
            found, have = found[live], have[live]
            if not k or not len(found):
                break
            cut = slice(self.starts[terms[k - 1]], self.starts[terms[k - 1] + 1])
            row[self.docs[cut]] = self.impacts[cut]
            have = have + row[found]
            row[self.docs[cut]] = 0
        if len(found):
            best.add(self.ids[found], self.known[found], have)


def _nth(scores: np.ndarray, n: int) -> int:
    return int(np.partition(scores, -n)[-n]) if len(scores) >= n else 0
