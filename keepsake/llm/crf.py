"""Language of every word in mixed text, by a linear-chain conditional random field.

A word's score for a language is the mean of learned weights of its features: the word itself (the
lexicon), its prefixes and suffixes, and the runs of 1 to 3 letters in it; hashing decides which
weight. Learned transitions say how likely one language follows another. Forward-backward gives
each word's probabilities, and a text's language is the one with the highest mean over its words.

Words are runs of letters, lower-cased. Forward-backward is exact over whole texts: texts are cut
into segments whose transfer matrices are built side by side, then chained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepsake.llm import text as tx
from keepsake.llm.quality import held_out

BUCKETS = 1 << 16
UNDETERMINED = "und"
# The sample that a model is fitted on: so many rows of each language, with their whole texts, cut
# into runs of words.
SAMPLE_TEXTS = 200
RUN_WORDS = 8
# Training sequences join so many runs, of any languages, so that transitions see switches.
_RUNS_IN_SEQUENCE = 3
EPOCHS = 4
RATE = 0.5
_SEGMENT = 64
_AFFIXES = (1, 2, 3)
_GRAMS = (1, 2, 3)


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: is it a letter, and its lower-case form if that is one letter."""
    chars = [chr(c) for c in range(0x110000)]
    lower = [x if len(x := c.lower()) == 1 else c for c in chars]
    return (
        np.array([c.isalpha() for c in chars]),
        np.array([ord(c) for c in lower], np.uint32),
    )


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-case code points of all texts, where words start and end in them, and which word is
    each text's first (and, last, the number of words)."""
    is_letter, lower = _letters()
    codes, bounds = tx.code_points(texts)
    codes = lower[codes]
    starts, ends = tx.spans(is_letter[codes])
    return codes, starts, ends, np.searchsorted(starts, bounds)


def _features(texts: list[str]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets of the distinct words.

    Returns (arrays of (bucket, distinct word), in ascending order of these), the number of features
    of each distinct word, which of them each word is, and where each text's words begin.
    """
    codes, starts, ends, cuts = _words(texts)
    roll = tx.Rolling(codes)
    lexicon, first, which = np.unique(
        roll.hashes(starts, ends), return_index=True, return_inverse=True
    )
    starts, ends = starts[first], ends[first]
    size = ends - starts
    words, n = np.arange(len(starts)), np.ones(len(starts))
    found = [(_salted(lexicon, 1), words)]
    for k in _AFFIXES:
        has = np.flatnonzero(size > k)
        s, e = starts[has], ends[has]
        found.append((_salted(roll.hashes(s, s + k), 1 + k), has))
        found.append((_salted(roll.hashes(e - k, e), 11 + k), has))
        n[has] += 2
    word = np.repeat(words, size)
    letters = np.arange(len(word)) + np.repeat(starts - np.cumsum(size) + size, size)
    for k in _GRAMS:
        if k > 1:  # a run of k letters begins where one of k - 1 does that isn't its word's last
            more = letters + k <= ends[word]
            letters, word = letters[more], word[more]
        found.append((_salted(roll.hashes(letters, letters + k), 21 + k), word))
        n += np.maximum(size - k + 1, 0)
    return found, n, which, cuts


def _salted(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes + np.uint64(kind * 0x9E3779B9)) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class LanguageField:
    languages: list[str]
    weights: np.ndarray  # bucket, language
    transitions: np.ndarray  # from, to

    def emissions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._emissions(*_features(texts))

    def _emissions(self, found, n, which, bounds) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(n), len(self.languages)), np.float32)
        for bucket, word in found:
            if len(word):
                change = np.flatnonzero(np.diff(word, prepend=-1))
                out[word[change]] += np.add.reduceat(self.weights[bucket], change)
        return (out / n[:, None].astype(np.float32))[which], bounds

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's probability of each language, and where each text's words begin."""
        emissions, bounds = self.emissions(texts)
        return _beliefs(emissions, bounds, self.transitions)[0], bounds

    def label_words(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, language, probability) of every word, places in code points."""
        is_letter, _ = _letters()
        codes, _ = tx.code_points([text])
        starts, ends = tx.spans(is_letter[codes])
        chance, _ = self.marginals([text])
        best = chance.argmax(1)
        return [
            (int(s), int(e), self.languages[b], float(p[b]))
            for s, e, b, p in zip(starts, ends, best, chance)
        ]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, mean probability over the words); `und` and 0 without letters."""
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        for a, b in tx.runs(texts, 1 << 21):
            chance, bounds = self.marginals(texts[a:b])
            sums = np.zeros((b - a, len(self.languages)))
            owner = np.repeat(np.arange(b - a), np.diff(bounds))
            for j in range(sums.shape[1]):
                sums[:, j] = np.bincount(owner, chance[:, j], b - a)
            n = np.diff(bounds)
            best = sums.argmax(1)
            for i in np.flatnonzero(n):
                names[a + i] = self.languages[best[i]]
                scores[a + i] = min(1.0, sums[i, best[i]] / n[i])
        return names, scores


def _beliefs(
    emissions: np.ndarray, bounds: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Every word's probabilities, and the backward message that it gets (up to a factor)."""
    n_words, k = emissions.shape
    lengths = np.diff(bounds)
    parts = -(-lengths // _SEGMENT)
    total = int(parts.sum())
    if not total:
        return np.zeros((0, k)), np.zeros((0, k))
    first = np.concatenate(([0], np.cumsum(parts)))
    owner = np.repeat(np.arange(len(lengths)), parts)
    begin = bounds[owner] + (np.arange(total) - first[owner]) * _SEGMENT
    size = np.minimum(bounds[owner + 1] - begin, _SEGMENT)
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    weight = np.exp(emissions - emissions.max(1, keepdims=True))
    longest = int(size.max())
    # The longest segments first, so that those with a t-th word are a prefix.
    order = np.argsort(-size, kind="stable")
    begin = begin[order]
    live = np.searchsorted(-size[order], -np.arange(longest), side="left")
    # Each segment's transfer matrix: the product of (step, weight) over its words.
    matrix = np.broadcast_to(np.eye(k, dtype=np.float32), (total, k, k)).copy()
    for t in range(longest):
        m = live[t]
        moved = (matrix[:m].reshape(-1, k) @ step).reshape(m, k, k)
        moved *= weight[begin[:m] + t][:, None, :]
        matrix[:m] = moved / moved.sum((1, 2), keepdims=True)
    chain = np.empty_like(matrix)
    chain[order] = matrix
    # Chain the segments of all texts at once, the m-th segments together.
    ahead = np.full((total, k), 1 / k, np.float32)
    behind = ahead.copy()
    most = int(parts.max())
    for m in range(1, most):
        s = first[:-1][parts > m] + m
        ahead[s] = _unit(np.einsum("ni,nij->nj", ahead[s - 1], chain[s - 1]))
    for m in range(2, most + 1):
        s = first[1:][parts >= m] - m
        behind[s] = _unit(np.einsum("nij,nj->ni", chain[s + 1], behind[s + 1]))
    forward = []
    state = ahead[order]
    for t in range(longest):
        here = begin[: live[t]] + t
        state = _unit((state[: live[t]] @ step) * weight[here])
        forward.append(state)
    out, messages = np.zeros((n_words, k), np.float32), np.zeros((n_words, k), np.float32)
    state = behind[order]
    for t in range(longest - 1, -1, -1):
        m = live[t]
        here = begin[:m] + t
        out[here], messages[here] = _unit(forward[t] * state[:m]), state[:m]
        state[:m] = _unit((state[:m] * weight[here]) @ step.T)
    return out, messages


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def fit(runs: list[tuple[str, str]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 1):
    """Fit to (run of words, language) by stochastic gradient ascent on the likelihood of whole
    label sequences. Runs are joined at random, so languages switch between them."""
    languages = sorted({lang for _, lang in runs})
    k = len(languages)
    weights, transitions = np.zeros((BUCKETS, k)), np.zeros((k, k))
    squares, moved = np.full((BUCKETS, k), 1e-4), np.full((k, k), 1e-4)
    rng = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(languages)}
    sizes = np.diff(_words([words for words, _ in runs])[3]).tolist()
    model = LanguageField(languages, weights, transitions)
    for _ in range(epochs):
        order = rng.permutation(len(runs))
        batch = 64 * _RUNS_IN_SEQUENCE
        for a in range(0, len(order), batch):
            texts, marks = [], []
            for b in range(a, min(a + batch, len(order)), _RUNS_IN_SEQUENCE):
                own = order[b : b + _RUNS_IN_SEQUENCE]
                texts.append(" ".join(runs[i][0] for i in own))
                marks += [number[runs[i][1]] for i in own for _ in range(sizes[i])]
            features = found, n, which, bounds = _features(texts)
            gold = np.array(marks, np.int64)
            emissions, _ = model._emissions(*features)
            chance, messages = _beliefs(emissions, bounds, transitions)
            error = -chance.astype(float)
            error[np.arange(len(gold)), gold] += 1
            gradient = np.zeros_like(weights)
            pull = np.zeros((len(n), k))
            np.add.at(pull, which, error)
            pull /= n[:, None]
            for bucket, word in found:
                np.add.at(gradient, bucket, pull[word])
            used = np.flatnonzero(gradient.any(1))
            squares[used] += gradient[used] ** 2
            weights[used] += rate * gradient[used] / np.sqrt(squares[used])
            inner = np.ones(len(gold), bool)
            inner[bounds[:-1][np.diff(bounds) > 0]] = False
            at = np.flatnonzero(inner)
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[at - 1], gold[at]), 1)
            # P(next | word) from the backward messages, times P(word).
            ahead = np.exp(emissions[at] - emissions[at].max(1, keepdims=True)) * messages[at]
            pair = np.exp(transitions)[None] * ahead[:, None, :]
            pair *= (chance[at - 1] / pair.sum(2))[:, :, None]
            slope = seen - pair.sum(0)
            moved += slope**2
            transitions += 0.1 * rate * slope / np.sqrt(moved)
    model.weights = weights.astype(np.float32)
    return model


def _runs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, lang in zip(batch["text"].fillna(""), batch["lang"]):
            codes, starts, ends, _ = _words([text])
            lowered = codes.tobytes().decode("utf-32-le", "surrogatepass")
            words = [lowered[a:b] for a, b in zip(starts, ends)]
            for s in range(0, len(words), RUN_WORDS):
                rows.append((" ".join(words[s : s + RUN_WORDS]), lang))
        yield pd.DataFrame(rows, columns=["words", "lang"])


def fit_sample(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> LanguageField:
    """Fit on the whole texts of the `texts` rows of each language that come first by hashes of their
    ids and texts.

    Rows set aside (crc32 of the id modulo 3 is 1) and rows without a language or id are not used.
    Rows with one language, id and text count once; an id's other rows are rows of their own. Only
    hashes are ranked, and Spark drops those beyond the limit before it shuffles them; the chosen
    ones, a bounded number for each language, are sent to all tasks and pick the texts there.
    """
    rows = docs.select(
        docs["doc_id"].cast("string").alias("key"), docs["lang"].alias("lang"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    ).where(
        F.col("lang").isNotNull() & F.col("key").isNotNull() & ~held_out(F.col("key"), 3, 1)
    ).withColumns({"place": F.xxhash64("key"), "mark": F.xxhash64("text")})
    by = ["lang", "place", "mark", "key"]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by[1:]))
    chosen = rows.select(by).distinct().select(*by, rank.alias("rank")).where(F.col("rank") <= texts)
    sample = rows.join(F.broadcast(chosen.drop("rank")), by).groupBy(by).agg(F.max("text").alias("text"))
    runs = sample.mapInPandas(_runs_of, "words string, lang string").orderBy("lang", "words").toPandas()
    return fit(list(zip(runs["words"], runs["lang"])))


def prediction(model: LanguageField, text: Column) -> Column:
    """Struct (lang_pred, score) of a text column; null and letterless texts are `und`, 0."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(texts.fillna("").tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict(text)


def identify(docs: DataFrame) -> DataFrame:
    """(key, held_out, lang_pred, score) for every row; key is its doc_id.

    The prediction looks at the whole text alone. Without any row to learn from, and for texts that
    are null, empty or without letters, it is `und` with score 0. Repeated rows are scored alike and
    fitted on once (see fit_sample). A text is worked on as a whole, with about 50 bytes of memory
    for each of its characters; so is each text of the sample, on the driver.
    """
    model = fit_sample(docs)
    return docs.select(
        docs["doc_id"].alias("key"),
        held_out(docs["doc_id"], 3, 1).alias("held_out"),
        prediction(model, docs["text"]).alias("p"),
    ).select("key", "held_out", "p.lang_pred", "p.score")
