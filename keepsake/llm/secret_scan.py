"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spends few tokens on words and many on random strings, so a string with few
characters per token is likely a key, of letters alone too. Candidates are runs of key characters.
Known digests (hexadecimal of the usual lengths, which the hex pattern lists anyway), UUIDs and
numbers are set aside, and so are names and paths whose parts, joined by marks, take few tokens
themselves. Added spans never replace those of the patterns.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, their kinds in order, and the least lengths.
KINDS = ("assign", "access", "hex", "token")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_LEAST, _ACCESS_LEAST, _HEX_LEAST = 12, 18, 16
# Runs have no longer run around them, so the least length can be part of the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (_ACCESS_LEAST - 4))
_HEX = re.compile(r"[0-9a-f]{%d,}" % _HEX_LEAST)

# Token-efficiency test: least length of a candidate, most characters per token.
LEAST_LENGTH = 20
MOST_CHARACTERS_PER_TOKEN = 2.1
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_LENGTH)
# How many candidates a task remembers the answers of at most, and the longest of them.
_REMEMBERED, _LONGEST = 100_000, 64

_DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
_IS_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_IDENTIFIERS = re.compile(
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # UUID
    r"|[0-9+/_=-]+"  # numbers, dates, rules
)
_MARKS = re.compile(r"[+/_=-]+")
# A part of a joined name; parts of so few letters can be abbreviations.
_PART = re.compile(r"([A-Za-z]*)[0-9]{0,4}")
_ABBREVIATION = 4


@cache
def token_counter(path: str, pattern: str) -> Callable[[str], int]:
    """Number of tokens of a string under a tiktoken rank file."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda s: len(coding.encode_ordinary(s))


def _is_joined(s: str, n_tokens: Callable[[str], int]) -> bool:
    """Is it made of words joined by marks? One token each, or few for the longer ones and for all."""
    parts = [p for p in _MARKS.split(s) if p]
    found = [_PART.fullmatch(p) for p in parts]
    if len(parts) < 2 or None in found:
        return False
    words = [m[1].lower() for m in found if m[1]]
    spent = [min(n_tokens(w), n_tokens(" " + w)) for w in words]
    if all(n == 1 for n in spent) and all(p.isalpha() or p.isdigit() for p in parts):
        return True
    if any(len(w) <= MOST_CHARACTERS_PER_TOKEN * n for w, n in zip(words, spent)
           if len(w) > _ABBREVIATION):
        return False
    return sum(map(len, words)) > MOST_CHARACTERS_PER_TOKEN * sum(spent)


def is_random(s: str, n_tokens: Callable[[str], int]) -> bool:
    """The test itself, for one candidate."""
    if _IDENTIFIERS.fullmatch(s):
        return False
    if _IS_HEX.fullmatch(s) and len(s) in _DIGEST_LENGTHS:
        return False
    return len(s) <= MOST_CHARACTERS_PER_TOKEN * n_tokens(s) and not _is_joined(s, n_tokens)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches, in order; kind is a place in KINDS."""
    out = [
        (m.start(), 0, m.end())
        for m in _ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= _ASSIGN_LEAST
    ]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def added_spans(text: str, n_tokens: Callable[[str], int], known: dict) -> list:
    """(start, kind, end) of candidates that the test finds random. known: answers so far."""
    out = []
    for m in _CANDIDATE.finditer(text):
        s = m.group()
        answer = known.get(s)
        if answer is None:
            answer = is_random(s, n_tokens)
            if len(s) <= _LONGEST:
                if len(known) >= _REMEMBERED:
                    known.clear()
                known[s] = answer
        if answer:
            out.append((m.start(), 3, m.end()))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches: Iterator[pd.DataFrame], path: str, pattern: str) -> Iterator[pd.DataFrame]:
    n_tokens, known = token_counter(path, pattern), {}
    for batch in batches:
        rows = []
        for text in batch["text"].fillna(""):
            base = base_spans(text)
            n = np.bincount([k for _, k, _ in base], minlength=3)
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            every = sorted(base + added_spans(text, n_tokens, known))
            rows.append((n[0], n[1], n[2], digest, _joined(every)))
        found = pd.DataFrame(
            rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        )
        yield pd.concat([batch[["key", "known"]].reset_index(drop=True), found], axis=1)


def scan(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans) for every row; key is its doc_id.

    spans lists kind:start:end, in code points with the end exclusive, by start and then kind, for
    the base patterns and for the kind `token` that the efficiency test adds; base_sha256 is the
    digest of the base patterns' list. A null or empty text has no spans. Rows are scanned one by
    one, so repeats are found in each, and an empty table gives an empty one; a text is scanned as a
    whole, whatever its length. Other columns are not looked at. vocabulary is a tiktoken rank file that every executor has, pattern its split.
    """
    rows = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("key"),
        docs["doc_id"].isNotNull().alias("known"),
        docs["text"].cast("string").alias("text"),
    )
    found = rows.mapInPandas(
        partial(_scan, path=vocabulary, pattern=pattern),
        "key long, known boolean, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string",
    )
    return found.withColumn("key", F.when(F.col("known"), F.col("key"))).drop("known")


def masked(text: str, spans: str) -> str:
    """The text with every listed span replaced by its kind in angle brackets; spans that overlap
    become one, of the first's kind."""
    out, last = [], 0
    for kind, a, b in (s.split(":") for s in spans.split(",") if s):
        a, b = int(a), int(b)
        if a >= last:
            out += [text[last:a], f"<{kind}>"]
        last = max(last, b)
    return "".join(out) + text[last:]
