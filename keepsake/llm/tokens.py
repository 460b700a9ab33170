"""Token ids in binary files: one wavelet matrix per block of documents.

Documents are dealt by ranges of their id, so that files, and blocks within a file, are in ascending
order of id. Each task tokenizes its range and writes one zstd-compressed Parquet file, whose rows
are blocks of about a million ids: document ids, lengths, and the packed bit-planes. Spark commits
a file as a whole, so a task that is run again replaces it. Tokens are read, counted and found from
the file alone.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.llm import text as tx
from keepsake.llm.wavelet import WaveletMatrix

# Ids after which a block ends with the document that reaches it.
BLOCK_TOKENS = 1 << 20
END_ID = 0
# How many pieces of text and ids a task remembers at most, and the longest piece.
_PIECES, _IDS, _LONGEST = 1 << 20, 1 << 22, 64
# Characters of text that are cut into pieces at once.
_RUN = 1 << 20
# A blank that is neither after nor before a printing character: cutting there changes the tokens.
_NO_CUT = re.compile(r"\s (?:\s|\Z)")
_BLANK, _LETTER, _DIGIT, _MARK, _FEED, _OTHER = range(6)


def _kinds() -> np.ndarray:
    """Of code points up to U+0250: what byte-level files cut between, and nowhere else."""
    kind = np.full(0x251, _OTHER, np.uint8)
    for first, last, what in (
        (0x21, 0x7E, _MARK), (0x30, 0x39, _DIGIT), (0x41, 0x5A, _LETTER), (0x61, 0x7A, _LETTER),
        (0xC0, 0xD6, _LETTER), (0xD8, 0xF6, _LETTER), (0xF8, 0x24F, _LETTER), (0x20, 0x20, _BLANK),
        (0x0A, 0x0A, _FEED),
        (0x27, 0x27, _OTHER),  # an apostrophe may begin a piece with letters in it
    ):
        kind[first : last + 1] = what
    return kind


_KIND = _kinds()


def _take(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of `size` from `first` on, one after another."""
    ends = np.cumsum(size)
    return ids[np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class _Table:
    """Ids of pieces, by hashes of the pieces in ascending order."""

    def __init__(self, marks=(), size=(), ids=()):
        self.marks, self.size = np.array(marks, np.uint64), np.array(size, np.int64)
        self.ids, self.first = np.array(ids, "<u4"), np.cumsum(self.size) - self.size

    def find(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the marks are known, and their rows."""
        if not len(self.marks):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.marks, marks), len(self.marks) - 1)
        hit = np.flatnonzero(self.marks[at] == marks)
        return hit, at[hit]

    def joined(self, other: _Table) -> _Table:
        """Both tables' pieces; none is in both."""
        order = np.argsort(marks := np.concatenate((self.marks, other.marks)))
        size = np.concatenate((self.size, other.size))
        first = np.concatenate((self.first, other.first + len(self.ids)))
        ids = _take(np.concatenate((self.ids, other.ids)), first[order], size[order])
        return _Table(marks[order], size[order], ids)


def _byte_letters() -> dict[int, str]:
    """How byte-level files write bytes: printing ones as they are, the others from U+0100 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printing)
    return {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_letters()


class Encoder:
    """A tokenizers file, applied to whole texts.

    Byte-level BPE with its usual pattern never joins characters across the start of a blank, so a
    text's ids are those of its chunks, each with the blank before it. Chunks of Latin letters,
    digits, marks and single line ends are cut further, between these kinds. Equal pieces are
    tokenized once, as long as a task remembers them. Texts that hold one of the file's added tokens
    go to the library as they are, and so do all texts if the file is of another kind.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        split = parts.get("pre_tokenizer") or {}
        self.by_chunk = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not parts.get("normalizer")
        )
        added = [token["content"] for token in parts.get("added_tokens") or ()]
        self.whole = re.compile("|".join([_NO_CUT.pattern, *map(re.escape, added)]))
        self.model = self.tokenizer.model
        self.known, self.recent = _Table(), _Table()

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def piece(self, text: str) -> list[int]:
        """A run of letters, digits or marks, with at most a blank before it."""
        if text.isascii():
            written = text.replace(" ", "Ġ")
        else:
            written = text.encode().decode("latin-1").translate(_BYTES)
        return [t.id for t in self.model.tokenize(written)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text. The list is cut by characters; a text is worked on as a whole."""
        out = []
        for a, b in tx.runs(texts, _RUN):
            cut = [bool(t) and self.by_chunk and not self.whole.search(t) for t in texts[a:b]]
            ids = iter(self._by_piece([t for t, c in zip(texts[a:b], cut) if c]))
            out += [next(ids) if c else self.plain(t) for t, c in zip(texts[a:b], cut)]
        return out

    def _by_piece(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        joined = "".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, simple = _cut(codes, ends)
        roll = tx.Rolling(codes)
        marks = roll.hashes(starts, np.append(starts[1:], len(codes)))
        marks, place, which = np.unique(marks, return_index=True, return_inverse=True)
        after = np.append(starts[1:], len(codes))[place]
        found = self._ids(marks, joined, starts[place], after, simple[place])
        size, flat = found.size[which], _take(found.ids, found.first[which], found.size[which])
        upto = np.concatenate(([0], np.cumsum(size)))
        bounds = upto[np.searchsorted(starts, ends)]
        return np.split(flat, bounds[:-1])

    def _ids(self, marks, joined: str, starts, ends, simple) -> _Table:
        """A table of just these pieces."""
        size, parts, at = np.zeros(len(marks), np.int64), [], np.zeros(len(marks), np.int64)
        total, new = 0, np.ones(len(marks), bool)
        for table in (self.known, self.recent):
            hit, row = table.find(marks)
            new[hit], size[hit] = False, table.size[row]
            parts.append(_take(table.ids, table.first[row], table.size[row]))
            at[hit] = total + np.cumsum(size[hit]) - size[hit]
            total += len(parts[-1])
        new = np.flatnonzero(new)
        rows = zip(starts[new].tolist(), ends[new].tolist(), simple[new].tolist())
        ids = [self.piece(joined[a:b]) if c else self.plain(joined[a:b]).tolist() for a, b, c in rows]
        size[new] = [len(x) for x in ids]
        at[new] = total + np.cumsum(size[new]) - size[new]
        parts.append(np.array([i for x in ids for i in x], "<u4"))
        flat = np.concatenate(parts)
        keep = new[(ends - starts)[new] <= _LONGEST]
        self._remember(_Table(marks[keep], size[keep], _take(flat, at[keep], size[keep])))
        return _Table(marks, size, _take(flat, at, size))

    def _remember(self, new: _Table) -> None:
        self.recent = self.recent.joined(new)
        if len(self.recent.marks) > (1 << 16) + len(self.known.marks) // 4:
            self.known, self.recent = self.known.joined(self.recent), _Table()
        if len(self.known.marks) > _PIECES or len(self.known.ids) > _IDS:
            self.known = _Table()


def _cut(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of texts start (a text ends at each of `ends`), and which consist of one kind of
    character, with at most a blank before it."""
    kind = _KIND[np.minimum(codes, 0x250)]
    first, last = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    first[0], last[ends - 1] = True, True
    first[ends[:-1]] = True
    printing = (kind == _LETTER) | (kind == _DIGIT) | (kind == _MARK)
    after = np.append(printing[1:], False) & ~last
    before = np.append(False, printing[:-1]) & ~first
    odd = (kind == _OTHER) | ((kind == _BLANK) & ~after) | ((kind == _FEED) & ~(before & after))
    chunk = np.flatnonzero(first | (kind == _BLANK))
    size = np.diff(np.append(chunk, len(codes)))
    simple = np.repeat(~np.logical_or.reduceat(odd, chunk), size)
    change = np.append(True, (kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK))
    change &= simple
    change[chunk] = True
    starts = np.flatnonzero(change)
    # A line end is tokenized by the whole pattern; there is one such piece.
    return starts, simple[starts] & (kind[starts] != _FEED)


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


_BLOCK = (
    "shard int, block int, first_token long, n_tokens long, doc_ids array<long>, "
    "lengths array<long>, symbols binary, planes binary"
)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    files: int | None = None,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Tokenize all documents into binary files below `path`.

    Order: doc_id (null first), then text. A null or empty text has the end id alone. Rows that
    share an id are dealt by a hash of their texts, so a frequent id is spread over files. Repeated
    rows are written as often as they occur; an empty table writes files without blocks. A text is
    worked on as a whole, with about 60 bytes of memory for each of its characters. Columns other
    than doc_id and text are not looked at.
    """
    end = np.array([end_id], "<u4")

    def encode(batches):
        coder, shard = _encoder(tokenizer), TaskContext.get().partitionId()
        block, first, held, size = 0, 0, [], 0

        def flush():
            nonlocal block, first, held, size
            raw = np.concatenate([part for _, ids in held for part in (ids, end)])
            symbols, planes = WaveletMatrix.pack(raw)
            row = (shard, block, first, size, [d for d, _ in held],
                   [len(ids) + 1 for _, ids in held], symbols, planes)
            block, first, held, size = block + 1, first + size, [], 0
            return pd.DataFrame([row], columns=_names(_BLOCK))

        for batch in batches:
            texts = batch["text"].tolist()
            keys = [int(d) if ok else None for d, ok in zip(batch["doc_id"], batch["known"])]
            for a, b in tx.runs(texts, _RUN):
                for key, ids in zip(keys[a:b], coder.encode_all(texts[a:b])):
                    held.append((key, ids))
                    size += len(ids) + 1
                    if size >= block_tokens:
                        yield flush()
        if held:
            yield flush()

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    ).withColumn("spread", F.xxhash64("text"))
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "doc_id", "spread").sortWithinPartitions(
        "doc_id", "spread", "text"
    )
    # Arrow hands a nullable long over as a float; ids travel as 0 with a mark beside them.
    sent = dealt.select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sent.mapInPandas(encode, _BLOCK).write.option("compression", "zstd").parquet(path)


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def _starts(blocks: DataFrame) -> dict[int, int]:
    """The ids before each file: one number per file reaches the driver."""
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens")).collect()
    out, before = {}, 0
    for shard, n in sorted(totals):
        out[shard] = before
        before += n
    return out


def _load(row) -> WaveletMatrix:
    return WaveletMatrix.load(row.symbols, row.planes, row.n_tokens)


def _id_list(ids) -> list:
    return [None if d is None or d != d else int(d) for d in ids]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    blocks = spark.read.parquet(path)
    starts = _starts(blocks)

    def decode(batches):
        for batch in batches:
            for row in batch.itertuples():
                raw = _load(row).all().astype("<u4").tobytes()
                lengths = np.asarray(row.lengths, np.int64)
                ends = np.cumsum(lengths)
                begins = ends - lengths
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(_id_list(row.doc_ids), "Int64"),
                        "start": begins + row.first_token + starts[row.shard],
                        "n_tokens": lengths,
                        "ids_crc32": [
                            zlib.crc32(raw[4 * a : 4 * b])
                            for a, b in zip(begins.tolist(), ends.tolist())
                        ],
                    }
                )

    return blocks.mapInPandas(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of some tokens occurs in all files, by rank alone."""

    def count(batches):
        for batch in batches:
            for row in batch.itertuples():
                matrix = _load(row)
                yield pd.DataFrame({"token": tokens, "n": [matrix.count(t) for t in tokens]})

    found = spark.read.parquet(path).mapInPandas(count, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, position) of every occurrence of a token, by select alone; position counts from 0
    within the document."""

    def find(batches):
        for batch in batches:
            for row in batch.itertuples():
                at = _load(row).occurrences(token)
                ends = np.cumsum(np.asarray(row.lengths, np.int64))
                doc = np.searchsorted(ends, at, side="right")
                begins = np.concatenate(([0], ends))
                ids = _id_list(row.doc_ids)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([ids[d] for d in doc], "Int64"),
                        "position": at - begins[doc],
                    }
                )

    return spark.read.parquet(path).mapInPandas(find, "doc_id long, position long")
