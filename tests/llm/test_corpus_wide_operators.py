"""Phrases, ranked search and repeated passages against their definitions, on odd rows too."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from keepsake.llm import dealt, lexical, passages, phrases

DOCS = "doc_id long, text string, lang string, key string, `Rank` string, dest int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "k", "r", 1) for i, t, lang in rows], DOCS).repartition(6)


# --- Numbers dealt out -----------------------------------------------------------------------


def test_dealt_arrays_come_back():
    rng = np.random.default_rng(0)
    dest, values = rng.integers(0, 9, 500), rng.integers(0, 50, 500)
    rows = dealt.deal(dest, {"v": values.astype("<i8"), "at": np.arange(500)})
    for d, v, at in zip(rows["dest"], rows["v"], rows["at"]):
        at = np.frombuffer(at, np.int64)
        assert (dest[at] == d).all() and (np.diff(at) > 0).all()
        assert (np.frombuffer(v, "<i8") == values[at]).all()
    assert len(dealt.deal(dest[:0], {"v": values[:0]})) == 0
    often = Counter(zip(dest.tolist(), values.tolist()))
    assert dealt.how_often(dest, values).tolist() == [often[x] for x in zip(dest.tolist(), values.tolist())]
    assert dealt.destinations(0) == 1 and dealt.destinations(10, 3) == 4


# --- Phrases ---------------------------------------------------------------------------------


def plain_phrases(rows, support, absorbed, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, 5):
                f[lang or "und"].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        longest = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(longest[p[i : i + m]], a)
        kept = []
        for p, a in often.items():
            if 100 * longest[p] >= absorbed * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    draw = random.Random(8)
    vocabulary = ["New", "york", "CITY", "hall", "of", "the", "é", "Été", "x1", "\x00", "日本", "-"]
    marks = [" ", "  ", "\t", ", ", ".", "\n", "; ", "\x0b", "\r\n"]
    rows = []
    for i in range(400):
        parts = []
        for _ in range(draw.randrange(0, 40)):
            parts += draw.choice([["new york city hall"], ["of the"], [draw.choice(vocabulary)]])
            parts.append(draw.choices(marks, [60, 3, 3, 4, 3, 2, 1, 1, 1])[0])
        rows.append((i, "".join(parts), draw.choice(["en", "de", None, "und", "x y"])))
    rows += [(1000, None, "en"), (1001, "", None), (None, "no id of the", "en"), (1002, " \t.;\n", "de")]
    rows += [(1003, "the very same text again of the city", "en")] * 150
    rows += [(1004, "of the " * 30_000, "de"), (1005, "only here", "zz")]
    return rows


@pytest.mark.parametrize("shards,run,held", [(8, 1 << 20, 1 << 19), (3, 300, 50), (1, 300, 1), (256, 1 << 20, 99)])
def test_phrases(spark, phrase_rows, shards, run, held):
    found = phrases.collocations(
        table(spark, phrase_rows), support=12, top=25, shards=shards, run=run, held=held
    )
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain_phrases(phrase_rows, 12, 80, 25)


def test_phrases_when_the_filter_is_full(spark, phrase_rows):
    """With 2^11 places nearly everything is let through, and the counts are the same."""
    found = phrases.collocations(table(spark, phrase_rows), support=12, top=25, filter_bits=11)
    assert sorted(map(tuple, found.collect())) == plain_phrases(phrase_rows, 12, 80, 25)


def test_ties_of_phrases_go_by_bytes(spark):
    texts = ["zz é. é zz. zz 日. z\U0001f389 b. zz b"] * 5
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    found = phrases.collocations(table(spark, rows), support=5, top=3)
    assert sorted(map(tuple, found.collect())) == plain_phrases(rows, 5, 80, 3)


def test_phrases_of_nothing(spark):
    empty = table(spark, [(1, "a", "en")]).limit(0)
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(table(spark, [(1, None, None), (2, "a b", "en")])).collect() == []
    with pytest.raises(ValueError, match="shards"):
        phrases.collocations(empty, shards=0)


# --- Search ----------------------------------------------------------------------------------


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_search(rows, items, top):
    docs = [(i, Counter(plain_terms(t))) for i, t, _ in rows]
    n_docs = sum(bool(c) for _, c in docs)
    n_terms = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            score, n = 0, sum(c.values())
            for t in set(plain_terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + 90 * n * n_docs // n_terms
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score:
                scored.append((-score, i is None, i or 0))
        for rank, (s, unknown, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if unknown else i, -s))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def search_rows():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(120)] + ["É", "日本語", "a_b", "don't", "½"]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(draw.choices(vocabulary, weight, k=draw.randrange(0, 60))), "en") for i in range(500)]
    rows += [(None, "w5 w90 w91", "en"), (None, None, None), (700, "", "en"), (701, "!? \n", "en")]
    rows += [(800, "w100 w101 the same", "en")] * 30 + [(801 + i, "w100 w101 the same", "en") for i in range(30)]
    rows += [(900, "w3 w99 " * 50_000, "en")]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(0, 25)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "nowhere else"), (103, "w100 w101"), (103, "w100 w101"),
              (None, "W5 w90 w5"), (104, "w0 w1 w2 w3")]
    return rows, items


@pytest.mark.parametrize("block,at_once,top", [(1 << 22, 2000, 10), (400, 2000, 3), (3000, 7, 40)])
def test_search(spark, search_rows, block, at_once, top):
    rows, items = search_rows
    queries = spark.createDataFrame([(*x, "clash") for x in items], "item_id int, text string, score string")
    found = lexical.search(table(spark, rows), queries, top, at_once, block).collect()
    assert sorted(map(tuple, found), key=repr) == plain_search(rows, items, top)


def test_pair_bounds_hold_and_are_tighter(spark, search_rows):
    rows, items = search_rows
    vocabulary = lexical.Vocabulary.of([t for _, t in items])
    blocks = lexical.build_index(table(spark, rows), vocabulary)
    statistics = lexical.Statistics.of(blocks, vocabulary)
    ranked = lexical._ranked(vocabulary.queries, statistics.weights)
    pairs = lexical._pairs(ranked)
    tighter = 0
    for row in lexical.with_impacts(blocks, statistics, pairs).toPandas().itertuples():
        block = lexical._Block(row, pairs)
        for terms in ranked:
            bounds = block.bounds(terms)
            scores = np.zeros(len(block.ids), np.int64)
            plain = 0
            for k, t in enumerate(terms):
                cut = slice(block.starts[t], block.starts[t + 1])
                scores[block.docs[cut]] += block.impacts[cut]
                plain += int(block.most[t])
                assert scores.max(initial=0) <= bounds[k + 1] <= plain
            tighter += bool(terms) and bounds[-1] < plain
    assert tighter > 50


def test_search_in_nothing(spark, search_rows):
    rows, items = search_rows
    queries = spark.createDataFrame(items, "item_id int, text string")
    docs = table(spark, rows)
    assert lexical.search(docs.limit(0), queries).count() == 0
    assert lexical.search(docs, queries.limit(0)).count() == 0
    assert lexical.search(docs.where("text IS NULL"), queries).count() == 0


# --- Passages --------------------------------------------------------------------------------


def plain_passages(rows, window):
    found, texts = Counter(), [WORD.findall(t or "") for _, t, _ in rows]
    for w in texts:
        found.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for (i, _, _), w in zip(rows, texts):
        gone = set()
        for s in range(len(w) - window + 1):
            if found[tuple(w[s : s + window])] > 1:
                gone.update(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passage_rows(window):
    rng = np.random.default_rng(window)
    word = lambda n: rng.integers(0, 10**6, n).astype(str).tolist()
    common = [word(window + k) for k in (-1, 0, 1, 40)]
    rows = []
    for i in range(120):
        parts = word(int(rng.integers(0, 90)))
        for _ in range(int(rng.integers(0, 3))):
            passage = common[int(rng.integers(0, 4))]
            at = int(rng.integers(0, len(parts) + 1))
            parts[at:at] = passage
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(parts), "en"))
    rows += [(500, rows[3][1] + " " + rows[3][1], "en"), (501, "again " * 300, "en")]
    rows += [(502, "a b " * 200, "en"), (503, " ".join(common[1]), "en")]
    rows += [(None, rows[7][1], None), (None, None, None), (504, "", "en"), (505, "\t\n ", "en")]
    rows += [(506, "Short Text", "en")] * 3 + [(507, " ".join(word(window)), "en")] * 4
    rows += [(508, " ".join(common[0]), "en"), (509, rows[3][1].replace(" ", "\x0b"), "en")]
    rows += [(510, " ".join(word(60_000) + common[3]), "en")]
    return rows


@pytest.mark.parametrize("window,run", [(35, 1 << 21), (35, 500), (21, 500), (50, 3000)])
def test_passages(spark, window, run):
    rows = passage_rows(window)
    found = passages.repeated_words(table(spark, rows), window, run).collect()
    assert sorted(map(tuple, found), key=repr) == plain_passages(rows, window)


def test_every_shift_has_a_common_place():
    cover = set(passages.COVER)
    for a in range(passages.PERIOD):
        for b in range(passages.PERIOD):
            assert any(
                (a + d) % passages.PERIOD in cover and (b + d) % passages.PERIOD in cover
                for d in range(passages.PERIOD)
            )


def test_spans_tell_what_was_removed(spark):
    rows = passage_rows(35)
    texts = {hashlib.md5((t or "").encode()).digest(): t or "" for _, t, _ in rows}
    for r in passages.judge(table(spark, rows)).collect():
        words = WORD.findall(texts[bytes(r.same)])
        kept = [w for k, w in enumerate(words) if not any(s.first <= k < s.after for s in r.spans)]
        assert len(words) - len(kept) == r.n_removed
        assert hashlib.sha256(" ".join(kept).encode()).hexdigest() == r.kept_sha256


def test_passages_of_nothing(spark):
    empty = table(spark, [(1, "a", "en")]).limit(0)
    assert passages.repeated_words(empty).collect() == []
    with pytest.raises(ValueError, match="21 words"):
        passages.repeated_words(empty, 20)
