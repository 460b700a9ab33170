"""Quality classifier: supervised subword embeddings.

A text is the mean of learned vectors, one for each of its words, for each run of 2 to 4 characters
within a word and its borders, and for each word that repeats the one before; hashing decides which
vector, repeats share one. A softmax layer on the mean
gives the class. Vectors and layer are fitted together by stochastic gradient descent in numpy, in
one task, over a bounded sample of labelled rows; the driver gets the fitted model alone. As the
layer is linear, a fitted model scores with one number per bucket, so scoring is a lookup for every
character, in Arrow batches, and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.llm import text as tx

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
DIMENSIONS = 16
# The most labelled rows that a model is fitted on.
SAMPLE_ROWS = 3000
# Steps of gradient descent, whatever the size of the sample.
STEPS = 24_000
RATE = 1.0
THRESHOLD = 0.3
# Characters of one text that are worked on at once.
PIECE = 1 << 19
# Stands for the end of a text, so that an empty text has a feature as well.
_END = 0
_REPEAT = 1


def _features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, owner) arrays: the features of all texts, and the text that each belongs to."""
    codes, bounds = tx.code_points([f" {t}" for t in texts])
    gap = tx.is_break(codes)
    codes = np.where(gap, np.uint32(32), codes)
    roll = tx.Rolling(codes)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    last = np.zeros(len(codes), bool)
    last[bounds[1:] - 1] = True
    yield np.full(len(texts), _END), np.arange(len(texts))
    starts, ends = tx.spans(~gap)
    words = roll.hashes(starts, ends)
    yield (words % np.uint64(BUCKETS)).astype(np.int64), owner[starts]
    again = starts[1:][(words[1:] == words[:-1]) & (owner[starts[1:]] == owner[starts[:-1]])]
    yield np.full(len(again), _REPEAT), owner[again]
    for bucket, at in _grams(roll, gap, ~last):
        yield bucket, owner[at]


def _grams(roll: tx.Rolling, gap: np.ndarray, begin: np.ndarray) -> Iterator[tuple]:
    """(bucket, place) arrays: the character n-grams from the places where one may begin, none of
    them with both borders of a word, which has a feature of its own."""
    for n in GRAMS:
        m = len(gap) - n + 1
        if m <= 0:
            continue
        good = begin[:m] & ~(gap[:m] & gap[n - 1 :])
        for k in range(1, n - 1):
            good &= ~gap[k : k + m]
        at = np.flatnonzero(good)
        yield (roll.grams(n)[at] % np.uint64(BUCKETS)).astype(np.int64), at


def _pieces(text: str, size: int) -> Iterator[np.ndarray]:
    """The buckets of one text's features, from `size` characters at once.

    A piece sees as much of the next one as an n-gram may need; a word that goes on in the next
    piece is hashed on there. So memory doesn't grow with the text.
    """
    text, tail = f" {text} ", max(GRAMS) - 1
    part, length = 0, 0
    before = np.zeros(0, np.uint64)
    yield np.array([_END])
    for a in range(0, len(text), size):
        codes, _ = tx.code_points([text[a : a + size + tail]])
        codes = codes[:-1]
        gap = tx.is_break(codes)
        roll = tx.Rolling(np.where(gap, np.uint32(32), codes))
        starts, ends = tx.spans(~gap[:size])
        sums, lengths = roll.sums(starts, ends), ends - starts
        if length and len(starts) and starts[0] == 0:
            sums[0] = tx.joined(part, length, int(sums[0]))
            lengths[0] += length
        elif length:
            sums = np.concatenate((np.array([part], np.uint64), sums))
            lengths = np.concatenate(([length], lengths))
        part = length = 0
        if len(ends) and ends[-1] == size:
            part, length = int(sums[-1]), int(lengths[-1])
            sums = sums[:-1]
        words = tx.mix(sums)
        yield (words % np.uint64(BUCKETS)).astype(np.int64)
        words = np.concatenate((before, words))
        yield np.full(np.count_nonzero(words[1:] == words[:-1]), _REPEAT)
        before = words[-1:]
        for bucket, _ in _grams(roll, gap, np.arange(len(codes)) < size):
            yield bucket


def _parts(texts: list[str], piece: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """_features of a run of texts, in pieces where it is one long text."""
    if len(texts) > 1 or len(texts[0]) <= piece:
        yield from _features(texts)
        return
    for bucket in _pieces(texts[0], piece):
        yield bucket, np.zeros(len(bucket), np.int64)


def counted_features(
    texts: list[str], piece: int = PIECE
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and how often each occurs."""
    out = []
    for a, b in tx.runs(texts, piece):
        if b - a == 1:
            total = np.zeros(BUCKETS, np.int64)
            for bucket, _ in _parts(texts[a:b], piece):
                total += np.bincount(bucket, minlength=BUCKETS)
            at = np.flatnonzero(total)
            out.append((at, total[at]))
            continue
        parts = list(_features(texts[a:b]))
        key = np.concatenate([o for _, o in parts]) * BUCKETS + np.concatenate([h for h, _ in parts])
        key, n = np.unique(key, return_counts=True)
        cuts = np.searchsorted(key, np.arange(b - a + 1) * BUCKETS)
        out += [(key[i:j] % BUCKETS, n[i:j]) for i, j in zip(cuts, cuts[1:])]
    return out


@dataclass
class SubwordClassifier:
    """log-odds of class 1 for each bucket; a text's log-odds are the mean over its features, plus
    the bias."""

    odds: np.ndarray
    bias: float

    def score(self, texts: list[str], piece: int = PIECE) -> np.ndarray:
        """Probability of class 1 for each text; `piece` characters of a long one at once."""
        out = np.empty(len(texts))
        for a, b in tx.runs(texts, piece):
            total, count = np.zeros(b - a), np.zeros(b - a)
            for bucket, owner in _parts(texts[a:b], piece):
                total += np.bincount(owner, self.odds[bucket], b - a)
                count += np.bincount(owner, minlength=b - a)
            out[a:b] = total / count + self.bias
        return 1 / (1 + np.exp(-out))


def train(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    steps: int = STEPS,
    rate: float = RATE,
    seed: int = 1,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of all buckets, and the softmax layer and its bias, fitted to (buckets, counts,
    class 0 or 1)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    step = 0
    while examples and step < steps:
        for i in rng.permutation(len(examples))[: steps - step]:
            now = rate * (1 - step / steps)
            step += 1
            bucket, n, label = examples[i]
            share = n / n.sum()
            mean = share @ vectors[bucket]
            logits = layer @ mean + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[label] -= 1
            back = error @ layer
            layer -= now * np.outer(error, mean)
            bias -= now * error
            vectors[bucket] -= now * np.outer(share, back)
    return vectors, layer, bias


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], **settings) -> SubwordClassifier:
    """`train`, with the vectors folded into one number each. Without examples every text scores
    one half."""
    vectors, layer, bias = train(examples, **settings)
    odds = vectors @ (layer[1] - layer[0])
    return SubwordClassifier(odds.astype(np.float32), float(bias[1] - bias[0]))


def _count_batches(batches):
    for batch in batches:
        found = counted_features(batch["text"].fillna("").tolist())
        yield pd.DataFrame(
            {
                "place": batch["place"],
                "label": batch["label"],
                "buckets": [b.astype("<u2").tobytes() for b, _ in found],
                "counts": [n.astype("<u4").tobytes() for _, n in found],
            }
        )


def _fit_batches(batches):
    """One row, the model fitted on all rows; they stay packed, and are unpacked step by step."""
    examples = []
    for batch in batches:
        for bucket, n, label in zip(batch["buckets"], batch["counts"], batch["label"]):
            examples.append((np.frombuffer(bucket, "<u2"), np.frombuffer(n, "<u4"), label))
    model = fit(examples)
    yield pd.DataFrame({"odds": [model.odds.tobytes()], "bias": [model.bias]})


def held_out(doc_id: Column, of: int = 5, rest: int = 0) -> Column:
    """True for rows set aside: crc32 of the id as text, modulo `of`, is `rest`."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of == rest


def fit_sample(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS
) -> SubwordClassifier:
    """Fit on the `rows` labelled rows that come first by a hash of their id.

    Only ids and labels are ordered; the chosen ids, at most `rows`, are broadcast to the texts. The
    rows' counted features meet in one task, in one order, so a retry fits the same model.
    Rows set aside by `held_out`, without a label or without a document are not used; where an id
    has several labels or texts each pair counts as a row, within the same bound.
    """
    known = labels.select(
        labels["doc_id"].alias("key"),
        labels[label].cast("int").alias("label"),
        F.xxhash64(labels["doc_id"].cast("string")).alias("place"),
    ).where(F.col("label").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key")))
    chosen = known.orderBy("place", "label").limit(rows)
    texts = docs.select(docs["doc_id"].alias("key"), docs["text"].alias("text"))
    sample = texts.join(F.broadcast(chosen), "key").select("place", "label", "text")
    counted = sample.mapInPandas(
        _count_batches, "place long, label int, buckets binary, counts binary"
    )
    sample = counted.orderBy("place", "label", "buckets", "counts").limit(rows)
    found = sample.coalesce(1).mapInPandas(_fit_batches, "odds binary, bias double").first()
    if found is None:  # no partition, no model
        return fit([])
    return SubwordClassifier(np.frombuffer(found["odds"], np.float32), found["bias"])


def score_column(model: SubwordClassifier, text: Column) -> Column:
    """Probability of class 1; null counts as an empty text, which has a score too."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.fillna("").tolist()))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) for every row; key is its doc_id.

    Learns from labelled rows that are not held out, looks at nothing but the whole text for a
    score, and predicts 1 if the score is at least the threshold. A null text counts as an empty
    one, which has a score too; equal texts have equal scores, so repeated rows do; a very long text
    is read piece by piece. Without labelled rows every score is one half. An empty table gives an
    empty one; other columns are not looked at.
    """
    model = fit_sample(docs, labels)
    return docs.select(
        docs["doc_id"].alias("key"),
        held_out(docs["doc_id"]).alias("held_out"),
        score_column(model, docs["text"]).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is at least the threshold, with all of their columns, whatever their
    names; otherwise as `classify`."""
    model = fit_sample(docs, labels)
    return docs.where(score_column(model, docs["text"]) >= threshold)
