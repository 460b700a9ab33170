"""Repeated passages by difference-cover anchors.

A difference cover modulo a period holds, for any two residues, a shift that moves both into the
cover. So if only places whose number modulo the period is in the cover are hashed, two equal
windows, wherever they start, still have a hashed place in common, less than a period from their
starts, and the words from there to the windows' end agree. These are the anchors: about a quarter
of all places. Windows around an anchor that occurs twice are then compared whole.

Equal texts are one text from the first step on. What tasks send is packed by destination; a value
that a batch has more than once is counted from one of its places, so a passage that a third of all
documents share costs a destination two entries a batch at most.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm import dealt
from keepsake.llm import text as tx

WINDOW = 35
# Differences of these numbers modulo the period make up every residue.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Characters of text that a task works on at once.
RUN = 1 << 21
_NOTHING = hashlib.sha256(b"").hexdigest()
# What an entry is: counted where it is dealt, counted and known to repeat, or only known to.
_OPEN, _FIRST, _KNOWN = 0, 1, 2
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def repeated_words(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) for every row; key is its doc_id.

    A word is removed if it is covered by a window of `window` words whose words also start
    anywhere else, in the same text or another. Windows are judged on the texts as given. Repeated
    rows and equal texts repeat each other; with fewer words than the window nothing is removed. Null
    and empty texts have no words. A null doc_id is kept as it is, and an empty table gives an empty
    one. A text is worked on as a whole, with about 60 bytes of memory for each of its characters.
    Columns other than doc_id and text are not looked at.
    """
    rows = docs.select(
        docs["doc_id"].alias("key"), F.unhex(F.md5(_text(docs))).alias("same"),
    )
    judged = judge(docs, window, run)
    copies = rows.groupBy("same").agg((F.count("*") > 1).alias("copied"))
    gone = F.col("copied") & (F.col("n_words") >= window)
    found = judged.join(copies, "same").select(
        "same", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, _NOTHING).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
    return rows.join(found, "same").select("key", "n_words", "n_removed", "kept_sha256")


def judge(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(same, n_words, n_removed, kept_sha256, spans) of every distinct text.

    same is the text's MD5; spans lists the removed passages as (first word, word after the last).
    Here a text's copies do not count, only other places.
    """
    anchor = window - PERIOD + 1
    if anchor < 1:
        raise ValueError(f"windows must have {PERIOD} words or more")
    texts = (
        docs.select(F.unhex(F.md5(_text(docs))).alias("same"), _text(docs).alias("text"))
        .where("same IS NOT NULL")  # as a join says; so all three uses are one exchange
        .groupBy("same")
        .agg(F.max("text").alias("text"))
    )
    # About one word for eight characters.
    places = (docs.agg(F.sum(F.length(_text(docs)))).first()[0] or 0) / 8
    n = dealt.destinations(places)

    sent = "dest int, mark binary, more binary, what binary, at binary, sizes binary, texts binary"
    anchors = texts.mapInPandas(_anchors(anchor, n, run), sent)
    near = texts.join(_repeats(anchors), "same", "left")
    windows = near.where("places IS NOT NULL").mapInPandas(_windows(window, n, run), sent)
    last = texts.join(_repeats(windows), "same", "left")
    return last.mapInPandas(
        _remove(window),
        "same binary, n_words long, n_removed long, kept_sha256 string, "
        "spans array<struct<first:long,after:long>>",
    )


def _text(docs: DataFrame):
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def _repeats(sent: DataFrame) -> DataFrame:
    """(same, places) from entries: all of a text's places whose value occurs twice or more, as
    runs of them, the first in the upper 32 bits and the one after the last in the lower."""
    found = sent.groupBy("dest").applyInPandas(_judged, "same binary, place long")
    return found.groupBy("same").agg(F.collect_list("place").alias("places"))


def _anchors(anchor: int, n: int, run: int):
    covered = np.zeros(PERIOD, bool)
    covered[list(COVER)] = True

    def find(batches):
        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["same"].to_numpy()
            for a, b in tx.runs(texts, run):
                words, bounds = tx.word_hashes(texts[a:b], lower=False)
                place, room = _places(bounds)
                at = np.flatnonzero(covered[place % PERIOD] & (room >= anchor))
                value = tx.Rolling(words).hashes(at, at + anchor)
                # A destination's own part of the value is compared: here a chance hit costs work
                # and nothing else.
                low = (value & np.uint64(0xFFFFFFFF)).astype("<u4")
                none = np.zeros(len(at), "<u1")
                yield from _sent(value >> np.uint64(32), low, none, at, bounds, place, keys[a:b], n)

    return find


def _windows(window: int, n: int, run: int):
    anchor = window - PERIOD + 1

    def find(batches):
        for batch in batches:
            texts, keys = batch["text"].tolist(), batch["same"].to_numpy()
            for a, b in tx.runs(texts, run):
                words, bounds = tx.word_hashes(texts[a:b], lower=False)
                place, room = _places(bounds)
                # A window that holds an anchor from its first PERIOD places on.
                first, after = _own_places(batch["places"].iloc[a:b], bounds)
                first = np.maximum(first - (PERIOD - 1), first - place[first])
                held = _cover(first, after, len(words)) & (room >= window)
                at = np.flatnonzero(held)
                if not len(at):
                    continue
                roll = tx.Rolling(words)
                one = roll.hashes(at, at + window)
                # Dealt by the least hash of the anchor-sized runs inside, which neighbours share:
                # windows of one passage travel, and return, as runs of places.
                least = np.lib.stride_tricks.sliding_window_view(roll.grams(anchor), PERIOD)
                by = np.concatenate([least[part].min(1) for part in np.array_split(at, 64)])
                two = tx.Rolling(tx.mix(words ^ _SECOND)).hashes(at, at + window)
                more = (two & np.uint64(0xFFFFFFFF)).astype("<u4")
                yield from _sent(by, one, more, at, bounds, place, keys[a:b], n)

    return find


def _remove(window: int):
    def remove(batches):
        for batch in batches:
            rows = []
            for same, text, places in zip(batch["same"], batch["text"], batch["places"]):
                words = _WORD.findall(text)
                spans = []
                if places is not None:
                    first, after = _runs(places)
                    covered = _cover(first, after + window - 1, len(words))
                    spans = list(zip(*(x.tolist() for x in tx.spans(covered))))
                kept, end = [], 0
                for first, after in spans:
                    kept += words[end:first]
                    end = after
                kept += words[end:]
                digest = hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest()
                marked = [{"first": first, "after": after} for first, after in spans]
                rows.append((same, len(words), len(words) - len(kept), digest, marked))
            names = ["same", "n_words", "n_removed", "kept_sha256", "spans"]
            yield pd.DataFrame(rows, columns=names)

    return remove


def _places(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every word: its number in its text, and how many words there are from it on."""
    size = np.diff(bounds)
    every = np.arange(bounds[-1])
    return every - np.repeat(bounds[:-1], size), np.repeat(bounds[1:], size) - every


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed runs of places: the first of each, and the one after the last."""
    return places >> 32, places & 0xFFFFFFFF


def _own_places(lists: pd.Series, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of places within texts as runs within all of them."""
    sizes = [len(places) for places in lists]
    first, after = _runs(np.concatenate(lists.tolist()))
    begin = np.repeat(bounds[:-1], sizes)
    return first + begin, after + begin


def _cover(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` places lie in a span."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def _sent(deal_by, mark, more, at, bounds, place, keys, n: int):
    """Entries of one run, packed by destination; a value that the run has twice or more is counted
    once there, and its other places go anywhere."""
    if not len(at):
        return
    order, begins = dealt.same(more, mark, deal_by)
    group = np.cumsum(begins) - 1
    many = np.bincount(group)[group] > 1
    what = np.full(len(at), _OPEN, "<u1")
    what[order[many]] = _KNOWN
    what[order[many & begins]] = _FIRST
    spread = tx.mix(at.astype(np.uint64) + mark.astype(np.uint64))
    dest = np.where(what == _KNOWN, spread, deal_by) % np.uint64(n)
    owner = np.searchsorted(bounds, at, side="right") - 1
    packed = dealt.deal(
        dest.astype(np.int64),
        {"mark": mark, "more": more, "what": what, "at": place[at].astype("<u4"),
         "texts": owner.astype("<u4")},
    )
    sizes, texts = [], []
    for owners in packed["texts"]:
        who, size = np.unique(np.frombuffer(owners, "<u4"), return_counts=True)
        sizes.append(size.astype("<u4").tobytes())
        texts.append(b"".join(keys[who]))
    packed["sizes"], packed["texts"] = sizes, texts
    yield packed[["dest", "mark", "more", "what", "at", "sizes", "texts"]]


def _judged(entries: pd.DataFrame) -> pd.DataFrame:
    what, at = dealt.joined(entries["what"], "u1"), dealt.joined(entries["at"], "<u4")
    raw = sum(map(len, entries["mark"])), sum(map(len, entries["more"]))
    mark = dealt.joined(entries["mark"], f"<u{raw[0] // len(what)}")
    more = dealt.joined(entries["more"], f"<u{raw[1] // len(what)}")
    counted = np.flatnonzero(what != _KNOWN)
    hit = what != _OPEN
    hit[counted] |= dealt.how_often(more[counted], mark[counted]) > 1
    sizes = dealt.joined(entries["sizes"], "<u4")
    owner = np.repeat(np.arange(len(sizes)), sizes)
    owner, at = owner[hit], at[hit].astype(np.int64)
    begins = np.ones(len(at), bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    raw_texts = b"".join(entries["texts"])
    return pd.DataFrame(
        {
            "same": [raw_texts[16 * i : 16 * i + 16] for i in owner[first].tolist()],
            "place": (at[first] << 32) + at[last] + 1,
        }
    )
