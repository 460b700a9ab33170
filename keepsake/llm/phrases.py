"""Phrase collocations by SON partitioning.

Texts are dealt to a fixed number of shards by a hash. A phrase with the wanted support in all texts
has, in one shard at least, that support times the shard's share of the texts. So each shard is
mined completely at its lowered support, level by level: first its words and pairs of words, then
longer phrases all of whose pairs are frequent there. The union of what is frequent somewhere holds
every frequent phrase; the next pass counts its members in all texts, exactly. Phrases travel as
64-bit hashes with their counts. Only those that turn out to be frequent are spelled, each by the
texts of one home, a small part of all texts that has it.

A shard is mined by many tasks: each sends the counts of its own texts to destinations by hash, and
these add them up. What comes back to the texts is a bitmap of fixed size, of frequent hashes:
a chance hit in it is counted in vain and changes nothing. So is what a larger corpus adds: where
the bitmap fills up, less is skipped, and the counts stay exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepsake.llm import dealt
from keepsake.llm import text as tx
from keepsake.llm.tables import stored

LONGEST = 4
SHARDS = 8
# The filters' places, as a power of two.
FILTER_BITS = 27
# Characters of text that a task works on at once, and counts that it adds up before it sends them.
RUN, HELD = 1 << 20, 1 << 19
_SLICES = 8  # a bitmap is put together in 2^_SLICES parts
_BASES = np.array(
    [0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_ODD = np.uint64(0x1D8E4E27C47D124F)
_LOW = np.uint64(0xFF)


def collocations(
    docs: DataFrame,
    support: int = 30,
    absorbed: int = 80,
    top: int = 2000,
    shards: int = SHARDS,
    filter_bits: int = FILTER_BITS,
    run: int = RUN,
    held: int = HELD,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` best phrases of 2 to 4 words.

    Texts are lower-cased in A-Z and cut into pieces at . , ; : ! ? and line ends, and pieces into
    words at blanks and tabs. Per language, n counts the words and f a phrase's occurrences within
    pieces. Of a phrase with a = f(phrase) >= support, every cut into two parts scores
    floor(2000000 a / (f(first) + f(rest))); the cut with the lowest score counts, and of equal ones
    the first. A phrase is left out if a longer one with a >= support holds it and has `absorbed`
    percent of its occurrences or more. Order: score, a, both descending, then the phrase's bytes.

    A null lang counts as `und`; null and empty texts have no words; repeated rows count each time;
    a text is worked on as a whole. An empty table, or one without frequent phrases, gives no rows.
    Columns other than text and lang are not looked at. filter_bits, run and held change the work and
    its memory, not the result.
    """
    if not 1 <= shards <= 256:
        raise ValueError("1 to 256 shards")
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    ).withColumns(
        {"shard": F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"),
         "home": F.pmod(F.xxhash64("text", F.lit(1)), F.lit(256)).cast("int")}
    )
    size = {r["shard"]: r["n"] or 0 for r in
            rows.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).collect()}
    total = sum(size.values())
    # Lowered in proportion to the shard's characters.
    lowered = np.array([max(1, -(-support * size.get(s, 0) // max(total, 1))) for s in range(256)])
    n = dealt.destinations(total / 3)

    broadcast = spark.sparkContext.broadcast
    mined = lambda sent: stored(_mined(sent, lowered, filter_bits), "phrases")
    found = mined(rows.mapInPandas(_short(n, run), _SENT))
    local = broadcast(_bitmap(found.where("NOT overall"), filter_bits))
    longer = mined(rows.mapInPandas(_long(n, run, local), _SENT))
    every = broadcast(_bitmap(found.union(longer).where("overall"), filter_bits))
    counts = rows.mapInPandas(_candidates(n, run, held, every), _COUNTED)
    frequent = stored(counts.groupBy("dest").applyInPandas(_frequent(support), _FREQUENT), "phrases")
    homes = frequent.where("size > 1").mapInPandas(_homes(filter_bits), "part int, places binary")
    at_home = broadcast(_bitmap(homes, filter_bits))
    named = rows.mapInPandas(_spelled(run, at_home), _SPELLED)
    return _ranked(frequent, stored(named, "phrases"), absorbed, top)


class _Words:
    """The words of some texts, and hashes of the phrases that start at each."""

    def __init__(self, texts: list[str], langs: np.ndarray):
        codes, bounds = tx.code_points(texts)
        self.codes = codes = tx.lower_ascii(codes)
        codes[bounds[1:] - 1] = 0x0A  # a text ends a piece
        ends_piece = (codes >= 0x0A) & (codes <= 0x0D)
        for mark in b".,;:!?":
            ends_piece |= codes == mark
        self.starts, self.ends = tx.spans(~(ends_piece | (codes == 0x20) | (codes == 0x09)))
        self.words = tx.Rolling(codes).hashes(self.starts, self.ends)
        self.piece = np.cumsum(ends_piece)[self.starts]
        self.text = np.searchsorted(bounds, self.starts, side="right") - 1
        self.lang = langs[self.text] if len(langs) else np.zeros(0, np.uint64)

    def phrase(self, at: np.ndarray, size: int) -> list[str]:
        """Phrases of `size` words; words may be apart by any blanks and tabs."""
        chars = self.codes.tobytes()

        def word(k: int) -> list[str]:
            cuts = zip((4 * self.starts[at + k]).tolist(), (4 * self.ends[at + k]).tolist())
            return [chars[a:b].decode("utf-32-le", "surrogatepass") for a, b in cuts]

        return list(map(" ".join, zip(*[word(k) for k in range(size)])))

    def phrases(self):
        """For 1, 2... words: where phrases start, and a hash of language and words at every word
        that has enough words after it in the texts."""
        sums = np.zeros(len(self.words), np.uint64)
        for n in range(1, LONGEST + 1):
            m = max(len(self.words) - n + 1, 0)
            sums = sums[:m] + self.words[n - 1 :] * _BASES[n - 1]
            inside = self.piece[n - 1 :] == self.piece[:m]
            yield n, inside, hash_of(sums, self.lang[:m], n)


def hash_of(sums: np.ndarray, lang: np.ndarray, n: int) -> np.ndarray:
    return tx.mix(sums + lang + np.uint64(n) * _ODD)


def _lang_hash(langs) -> np.ndarray:
    return tx.Rolling((c := tx.code_points(list(langs)))[0]).hashes(c[1][:-1], c[1][1:])


def _runs(batch: pd.DataFrame, run: int):
    texts = batch["text"].tolist()
    names, which = np.unique(batch["lang"].to_numpy(str), return_inverse=True)
    hashes = _lang_hash(names)[which] if len(names) else np.zeros(0, np.uint64)
    for a, b in tx.runs(texts, run):
        yield slice(a, b), _Words(texts[a:b], hashes[a:b]), names, which[a:b]


# A hash without its lowest byte, which is the shard; and how often it occurs in some texts.
_SENT = "dest int, mark binary, times binary"


def _counted(marks: list[np.ndarray], n: int) -> pd.DataFrame:
    marks, times = np.unique(np.concatenate(marks), return_counts=True)
    dest = (tx.mix(marks) % np.uint64(n)).astype(np.int64)
    return dealt.deal(dest, {"mark": marks, "times": times.astype("<u4")})


def _short(n: int, run: int):
    def count(batches):
        for batch in batches:
            shard = batch["shard"].to_numpy(np.uint64)
            for cut, words, *_ in _runs(batch, run):
                marks = []
                for size, inside, value in words.phrases():
                    if size > 2:
                        break
                    own = shard[cut][words.text[: len(value)]]
                    marks.append(((value & ~_LOW) | own)[inside])
                yield _counted(marks, n)

    return count


def _long(n: int, run: int, frequent):
    def count(batches):
        bits = frequent.value
        for batch in batches:
            shard = batch["shard"].to_numpy(np.uint64)
            for cut, words, *_ in _runs(batch, run):
                marks, pair = [], None
                for size, inside, value in words.phrases():
                    if size == 1:
                        continue
                    mark = (value & ~_LOW) | shard[cut][words.text[: len(value)]]
                    if size == 2:
                        pair = inside & _has(bits, mark)
                        held = pair
                        continue
                    held = held[: len(value)] & pair[size - 2 :]
                    marks.append(mark[held & inside])
                yield _counted(marks, n)

    return count


def _mined(sent: DataFrame, lowered: np.ndarray, bits: int) -> DataFrame:
    """What is frequent in a shard, as places in the bitmap: (overall, part, places), with or without
    regard to the shard."""

    def add_up(entries: pd.DataFrame) -> pd.DataFrame:
        marks = dealt.joined(entries["mark"], "<u8")
        order = np.argsort(marks)
        first = np.flatnonzero(np.diff(marks[order], prepend=~marks[order][:1]))
        sums = np.add.reduceat(dealt.joined(entries["times"], "<u4")[order].astype(np.int64), first)
        marks = marks[order][first]
        marks = marks[sums >= lowered[(marks & _LOW).astype(int)]]
        out = []
        for overall, values in ((False, marks), (True, marks & ~_LOW)):
            out.append(_packed(values, bits).assign(overall=overall))
        return pd.concat(out)[["overall", "part", "places"]]

    if_any = sent.where("length(mark) > 0")
    return if_any.groupBy("dest").applyInPandas(add_up, "overall boolean, part int, places binary")


def _place(marks: np.ndarray, bits: int) -> np.ndarray:
    return (tx.mix(marks * _ODD) >> np.uint64(64 - bits)).astype(np.int64)


def _packed(marks: np.ndarray, bits: int) -> pd.DataFrame:
    places = np.unique(_place(marks, bits))
    packed = dealt.deal(places >> (bits - _SLICES), {"places": places.astype("<u4")})
    return packed.rename(columns={"dest": "part"})


def _bitmap(found: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits, of places: each part is put together by a task, and 2^_SLICES parts of fixed
    size reach the driver."""
    own = 1 << (bits - _SLICES)

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        have = np.zeros(own, bool)
        have[dealt.joined(rows["places"], "<u4") & (own - 1)] = True
        return pd.DataFrame({"part": rows["part"].iloc[:1], "bits": [np.packbits(have).tobytes()]})

    parts = found.groupBy("part").applyInPandas(part, "part int, bits binary").collect()
    out = np.zeros((1 << _SLICES, own // 8), np.uint8)
    for row in parts:
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _has(bitmap: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = _place(marks, len(bitmap).bit_length() + 2)
    return (bitmap[at >> 3] << (at & 7).astype(np.uint8)) & 0x80 != 0


# How often phrases occur in some texts, their numbers of words, and a home each: a part of the
# texts that has them. With 0 words: how many words a language has.
_COUNTED = "dest int, mark binary, times binary, size binary, home binary"


def _candidates(n: int, run: int, held: int, every):
    def send(parts):
        size, mark, times, home = (np.concatenate(x) for x in zip(*parts))
        order, begins = dealt.same(size, mark)
        first = np.flatnonzero(begins)
        at = order[first]
        arrays = {"mark": mark[at], "times": np.add.reduceat(times[order], first).astype("<i8"),
                  "size": size[at], "home": home[at]}
        return dealt.deal((mark[at] % np.uint64(n)).astype(np.int64), arrays)

    def count(batches):
        bits, parts = every.value, []
        for batch in batches:
            for cut, words, names, which in _runs(batch, run):
                home = batch["home"].to_numpy(np.uint8)[cut]
                for size, inside, value in words.phrases():
                    at = np.flatnonzero(inside & _has(bits, value & ~_LOW))
                    mark, first, times = np.unique(value[at], return_index=True, return_counts=True)
                    own = home[words.text[at[first]]]
                    parts.append((np.full(len(mark), size, "<u1"), mark, times, own))
                langs, times = np.unique(which[words.text], return_counts=True)
                none = np.zeros(len(langs), "<u1")
                parts.append((none, _lang_hash(names[langs]), times, none))
                if sum(len(part[0]) for part in parts) >= held:
                    yield send(parts)
                    parts = []
        if parts:
            yield send(parts)

    return count


_FREQUENT = "mark long, size int, a long, home int"


def _frequent(support: int):
    def add_up(entries: pd.DataFrame) -> pd.DataFrame:
        size, mark = dealt.joined(entries["size"], "u1"), dealt.joined(entries["mark"], "<u8")
        order, begins = dealt.same(size, mark)
        first = np.flatnonzero(begins)
        a = np.add.reduceat(dealt.joined(entries["times"], "<i8")[order], first)
        at = order[first]
        keep = a >= np.where(size[at] > 0, support, 1)
        at, a = at[keep], a[keep]
        home = dealt.joined(entries["home"], "u1")[at]
        return pd.DataFrame(
            {"mark": mark[at].view(np.int64), "size": size[at].astype(np.int32), "a": a,
             "home": home.astype(np.int32)}
        )

    return add_up


def _at_home(marks: np.ndarray, home: np.ndarray) -> np.ndarray:
    return tx.mix(marks + (home.astype(np.uint64) + np.uint64(1)) * _ODD)


def _homes(bits: int):
    def pack(batches):
        for batch in batches:
            marks = batch["mark"].to_numpy(np.int64).view(np.uint64)
            yield _packed(_at_home(marks, batch["home"].to_numpy()), bits)

    return pack


# A frequent phrase's words, and the hashes of its parts: up to and from each cut, and shorter
# phrases inside.
_SPELLED = (
    "mark long, lang string, lang_mark long, phrase string, firsts array<long>, "
    "rests array<long>, inner array<long>"
)


def _spelled(run: int, frequent):
    """Frequent phrases as found in their homes, some more than once; chance hits among them."""

    def spell(batches):
        bits = frequent.value
        for batch in batches:
            for cut, words, names, which in _runs(batch, run):
                home = batch["home"].to_numpy(np.uint8)[cut]
                for size, inside, value in words.phrases():
                    if size == 1:
                        continue
                    own = home[words.text[: len(value)]]
                    at = np.flatnonzero(inside & _has(bits, _at_home(value, own)))
                    mark, first = np.unique(value[at], return_index=True)
                    if not len(mark):
                        continue
                    first = at[first]
                    lang = words.lang[first]
                    found = {"mark": mark.view(np.int64), "lang": names[which[words.text[first]]],
                             "lang_mark": lang.view(np.int64), "phrase": words.phrase(first, size)}
                    tuples = words.words[first[:, None] + np.arange(size)]
                    for name, spans in _spans(size).items():
                        parts = [hash_of_words(tuples[:, i:j], lang) for i, j in spans]
                        parts = np.array(parts, np.uint64).reshape(len(spans), len(first))
                        found[name] = list(parts.view(np.int64).T)
                    yield pd.DataFrame(found)

    return spell


def _spans(size: int) -> dict[str, list[tuple[int, int]]]:
    inner = [(i, i + m) for m in range(2, size) for i in range(size - m + 1)]
    return {
        "firsts": [(0, k) for k in range(1, size)], "rests": [(k, size) for k in range(1, size)],
        "inner": inner,
    }


def hash_of_words(words: np.ndarray, lang: np.ndarray) -> np.ndarray:
    sums = (words * _BASES[: words.shape[1]]).sum(1, dtype=np.uint64)
    return hash_of(sums, lang, words.shape[1])


def _ranked(frequent: DataFrame, named: DataFrame, absorbed: int, top: int) -> DataFrame:
    total = frequent.where("size = 0").select(F.col("mark").alias("lang_mark"), F.col("a").alias("n"))
    part = frequent.where("size > 0").select("mark", F.col("a").alias("f"))
    candidates = named.dropDuplicates(["mark"]).join(
        frequent.where("size > 1").select("mark", "a"), "mark"
    )
    # The parts of a frequent phrase are frequent, so each finds its count.
    cuts = candidates.select(
        "lang", "lang_mark", "mark", "phrase", "a",
        F.posexplode(F.arrays_zip("firsts", "rests")).alias("k", "cut"),
    ).select("lang", "lang_mark", "mark", "phrase", "a", "k", "cut.firsts", "cut.rests")
    cuts = cuts.join(part.toDF("firsts", "l"), "firsts").join(part.toDF("rests", "r"), "rests")
    whole = "decimal(38,0)"
    score = F.expr(
        f"cast(2000000 * cast(a as {whole}) div (cast(l as {whole}) + r) as long)"
    ).alias("score")
    worst = cuts.groupBy("lang", "lang_mark", "mark", "phrase", "a").agg(
        F.min(F.struct(score, "k", "l", "r")).alias("w")
    )
    longer = (
        candidates.select(F.explode("inner").alias("mark"), "a")
        .groupBy("mark").agg(F.max("a").alias("longer"))
    )
    left = worst.join(longer, "mark", "left").where(
        f"longer IS NULL OR 100 * cast(longer as {whole}) < {absorbed} * cast(a as {whole})"
    )
    scored = left.select("lang", "lang_mark", "phrase", "a", "w.l", "w.r", "w.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang_mark").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
