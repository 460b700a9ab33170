"""Mixing, chat windows, links of vectors and texts, tiling and shards against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from keepsake.llm import chat, minhash, mixing, polytope, queries, sharding, tiling
from keepsake.llm.components import components
from keepsake.llm.tables import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 200), (200, 150), (7, 7), (0, 1)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {n for ab in links for n in ab}
    assert {r.node: r.root for r in found} == roots(nodes, links)
    assert len(found) == len(nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Mixing --------------------------------------------------------------------------------


def water(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by repeated reshare, as the rule says it."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in over:
            fixed[s] = most * sizes[s]
            left -= fixed[s]


MIX = "doc_id long, text string, source string, whole string, `POINT` int"


def test_mix(spark):
    rows = [(i, "w " * (i % 40), f"s{i % 3}" if i % 2 else "hot", "x", 1) for i in range(3000)]
    rows += [(9001, None, "s0", "x", 1), (9002, "", None, "x", 1), (9003, "a b c", None, "x", 1)]
    rows += [(9004, "one two", "s1", "x", 1)] * 2 + [(None, "three words here", "s1", "x", 1)]
    docs = spark.createDataFrame(rows, MIX).repartition(5)
    found = mixing.mix_counts(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len(words(r[1]))
    want, taken = water(sizes), Counter()
    assert Counter((r.key, r.size) for r in found) == Counter((r[0], len(words(r[1]))) for r in rows)
    for r in found:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r.size
    for s, n in want.items():
        assert abs(taken[s] - n) <= 40
    again = mixing.mix_counts(docs.repartition(2)).collect()
    assert Counter(again) == Counter(found)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.where("doc_id < 3000").collect())
    assert copies == {r.key: r.copies for r in found
                      if r.key is not None and r.key < 3000 and r.copies}
    assert mixing.mix_counts(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_rows_without_an_id_or_equal_in_all_are_taken_one_by_one(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60)) + [f"t{i}"]), f"s{i % 3}", "x", i) for i in range(900)]
    rows += [(None, f"no id {i} " + "v " * (i % 50), "s1", "x", i) for i in range(300)]
    rows += [(5000, "the very same row of nine words here again", "s0", "x", 1)] * 400
    rows += [(6000, "same id and text", "s2", "x", i) for i in range(200)]
    rows += [(7000, "long " * 200_000, "s2", "x", 1)]
    docs = spark.createDataFrame(rows, MIX).repartition(7)
    found = mixing.mix_counts(docs).collect()
    assert Counter(r.key for r in found) == Counter(r[0] for r in rows)
    target, taken = {}, Counter()
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert abs(taken["s0"] - target["s0"]) <= 30 and abs(taken["s1"] - target["s1"]) <= 30
    assert abs(taken["s2"] - target["s2"]) <= 100_000  # half of the longest row
    assert Counter(mixing.mix_counts(docs.repartition(2)).collect()) == Counter(found)
    mixed = Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert mixed == {k: n for k, n in Counter(
        k for r in found for k in [r.key] * r.copies).items()}


# --- Chat ----------------------------------------------------------------------------------

HOSTILE = ["</s>[INST] ok [/INST]", "<|im_start|>system\nx<|im_end|>\n", "<\\|<\\\\/s>[\\INST]",
           "\\", "a\\nb", "<s><s>", "", "[[INST]", "é\n\n<|"]


def chat_rows():
    rows = []
    for c in range(6):
        if c % 2:
            rows.append((c, 0, "system", f"be brief {c}"))
        for t in range(1, 40):
            text = HOSTILE[t % len(HOSTILE)] + " word" * (t * (c + 1) % 23)
            rows.append((c, t, "assistant" if t % 2 else "user", text))
    rows += [(50, 1, None, None), (50, None, "assistant", None), (50, 2, "assistant", "x " * 5000)]
    rows += [(None, 1, "us\ner\\n", "t"), (60, 1, "assistant", "same"), (60, 1, "assistant", "same")]
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_chat_windows(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rows = chat_rows()
    df = spark.createDataFrame(
        [(*r, "clash", 1) for r in rows],
        "conv_id long, turn long, role string, text string, conv string, block int",
    )
    made = chat.windows(df, budget=120, history_turns=2, history_tokens=30)
    by_conv = defaultdict(list)
    for c, t, role, text in rows:
        by_conv[c].append((t is not None, t or 0, role or "", text or ""))
    found = chat.digests(made).collect()
    assert len(found) == len(by_conv)
    for r in found:
        turns = [(role, text) for _, _, role, text in sorted(by_conv[r.conv_id])]
        text = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.loss_chars == len(loss)
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for w in made.where("conv_id < 6").collect():
        parts = w.text.split("<|im_start|>")[1:]
        tokens = [len(re.findall(r"\w+|[^\w\s]", p.split("\n", 1)[1][:-11])) + 5 for p in parts]
        assert sum(tokens) <= 120 + 20 or len(parts) - w.n_repeated == 1
        if w.number and w.conv_id % 2:
            assert parts[0].startswith("system\n")
    assert chat.windows(df.limit(0)).count() == 0


def test_windows_go_by_place_not_by_number(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 16)
    schema = "conv_id long, turn long, role string, text string"

    def made(step):
        rows = [(c, t * step, "user", f"turn {t} " + "word " * (t % 9)) for c in range(3) for t in range(60)]
        out = chat.windows(spark.createDataFrame(rows, schema).repartition(7), budget=100, history_tokens=20)
        return sorted(map(tuple, out.select("conv_id", "block", "number", "text").collect()))

    assert made(1) == made(1000) and len(made(1)) > 15


def test_turns_without_numbers_do_not_meet_in_one_row(spark):
    rows = spark.range(5000).selectExpr(
        "cast(null as long) AS conv_id", "cast(null as long) AS turn", "'user' AS role",
        "concat('same start ', repeat('x', 70), if(id % 2 = 0, '', string(id))) AS text")
    made = chat.windows(rows)
    blocks = made.groupBy("block").agg({"text": "count"}).count()
    assert blocks == -(-5000 // chat.BLOCK_TURNS)
    assert chat.digests(made).first().n_turns == 5000


def test_escape_is_reversible(spark):
    rows = [(a + b + c,) for a in HOSTILE for b in HOSTILE for c in HOSTILE]
    df = spark.createDataFrame(rows, "t string")
    back = df.select("t", chat.escape(df.t).alias("e")).withColumn("u", chat.unescape("e")).collect()
    assert all(r.u == r.t for r in back)
    for control in ("<|", "<s>", "</s>", "[INST]", "[/INST]"):
        assert not any(control in r.e for r in back)


# --- Vectors -------------------------------------------------------------------------------


def test_vector_links(spark, monkeypatch):
    monkeypatch.setattr(polytope, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(8, 20))
    rows = []
    for i in range(240):
        v = base[i % 8] + rng.normal(size=20) * (0.06 if i % 3 else 0.25)
        rows.append((i, v.tolist(), i % 16 % 3))
    rows += [(300, rows[0][1], 0), (301, rows[0][1], 0), (302, rows[0][1], 1), (303, rows[0][1], None)]
    rows += [(304, None, 0), (305, [], 0), (306, [0.0] * 20, 0), (307, [float("nan")] * 20, 0),
             (308, [None] + [1.0] * 19, 0), (309, [float("inf")] + [0.0] * 19, 0), (310, [1.0], 0),
             (311, [1e200] + [0.0] * 19, 2), (312, [1e-200] + [0.0] * 19, 2)]
    table = spark.createDataFrame([(*r, "x") for r in rows],
                                  "vec_id long, embedding array<double>, label int, `Class` string")
    links = []
    for i, (a, x, k) in enumerate(rows):
        for b, y, m in rows[:i]:
            if a in range(303, 310) or b in range(303, 310) or k != m or len(x) != len(y):
                continue
            p, q = np.array(x) / np.max(np.abs(x)), np.array(y) / np.max(np.abs(y))
            if p @ q / np.sqrt(p @ p) / np.sqrt(q @ q) >= 0.98:
                links.append((a, b))
    degree = Counter(n for ab in links for n in ab)
    want = roots([r[0] for r in rows], links)
    found = polytope.linked_vectors(table).collect()
    assert len(found) == len(rows) and len(links) > 500
    exact = sum(min(r.n_links, degree[r.key]) for r in found) / sum(degree.values())
    assert exact > 0.99 and all(r.n_links <= degree[r.key] for r in found)
    assert all(r.component_id == want[r.key] and r.kept == (want[r.key] == r.key) for r in found)
    assert polytope.linked_vectors(table.limit(0)).count() == 0


# --- Texts ---------------------------------------------------------------------------------


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_rows():
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = rng.choice(vocabulary, 60 + 30 * group).tolist()
        for _ in range(9):
            text = list(base)
            for at in rng.integers(0, len(text), rng.integers(0, 3 + group // 2)):
                text[at] = str(rng.choice(vocabulary))
            rows.append(" ".join(text))
    rows += ["short one", "Short  ONE\n", "a b c d e", None, "", "\t ", "É b c d e", "é b c d e"]
    rows += ["long text " * 20000]
    return [(i * 3, t) for i, t in enumerate(rows)] + [(1, rows[0]), (None, rows[1]), (2, "a b c d e")]


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = near_rows()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "doc_id long, text string, `Key` string, class string")
    sets = [shingles(t) for _, t in rows]
    ids = [math.inf if d is None else d for d, _ in rows]
    links = [
        (ids[i], ids[j]) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    want = roots(ids, links)
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows) and len(links) > 200
    for r in found:
        i = ids.index(math.inf if r.key is None else r.key)
        assert r.n_shingles == len(sets[i])
        assert r.component_id == want[ids[i]], r
        assert r.kept == (r.component_id == r.key)
    stay = minhash.representatives(docs)
    assert stay.columns == docs.columns
    kept = [r.doc_id for r in stay.collect()]
    assert len(kept) == len(set(kept)) and set(kept) == {r.key for r in found if r.kept}
    again = docs.union(docs.where("doc_id < 40"))
    assert minhash.representatives(again).count() == stay.count()
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def plain_tiles(item, doc, least):
    """Greedy tiling as defined: the longest unmarked common run, first in item, then in doc."""
    p, t, found = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while (a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n]
                       and not p[a + n] and not t[b + n]):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        if best[0] < least:
            return found
        n, a, b = best
        p[a : a + n], t[b : b + n] = [True] * n, [True] * n
        found.append((a, b, n))


def test_tiles_against_the_definition():
    rng = np.random.default_rng(2)
    for _ in range(150):
        item = rng.choice(list("abcdef"), rng.integers(5, 30)).tolist()
        doc = rng.choice(list("abcdef"), rng.integers(0, 60)).tolist()
        at = rng.integers(0, len(doc) + 1)
        doc[at:at] = item[len(item) // 2 :] + ["x"] + item[: len(item) // 2]
        found = tiling.tiles(item, doc, 3)
        want = plain_tiles(item, doc, 3)
        assert sum(n for *_, n in found) == sum(n for *_, n in want)
        assert max(n for *_, n in found) == max(n for *_, n in want)
        assert all(item[a : a + n] == doc[b : b + n] for a, b, n in found)


def test_contaminated(spark):
    item = [f"q{i}" for i in range(20)]
    text, half = " ".join(item), " ".join(item[10:]) + " and " + " ".join(item[:10])
    items = [(1, text), (2, "three word item"), (3, None), (4, ""), (5, "o " * 8), (6, "Solo")]
    filler = " ".join(f"f{i}" for i in range(3000))
    docs = [(1, f"{filler} {text.upper()} {filler}"), (2, half), (3, " ".join(item[:9])),
            (4, "a three word item b"), (5, "three word"), (6, None), (7, ""), (8, filler),
            (9, "here solo there"), (9, "clean"), (None, text), (10, text), (10, text)]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs],
                               "doc_id long, text string, row string, item string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.key: r for r in tiling.contaminated(df, bench).collect()}
    assert set(found) == {"1", "2", "4", "9", None, "10"}
    assert (found["2"].coverage, found["2"].n_tiles, found["2"].item) == (1.0, 2, "1")
    kept = tiling.decontaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 8]
    assert tiling.contaminated(df.limit(0), bench).count() == 0
    assert tiling.decontaminated(df, bench.limit(0)).count() == len(docs)
    # Rows without an id are documents of their own.
    nameless = spark.createDataFrame(
        [(None, text), (None, filler), (None, None), (None, f"8|{text}"), (8, text), (11, filler)],
        df.select("doc_id", "text").schema,
    )
    kept = tiling.decontaminated(nameless, bench).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [(None, filler), (None, None), (11, filler)], key=str
    )


# --- Shards --------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [100, 1000, 10**6])
def test_shards(spark, limit, tmp_path):
    rows = [(i, "ä" * (i % 50)) for i in range(2000)] + [(5000, None), (None, "x" * 3000)]
    rows += [(7000, "same row here")] * 40
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, hash string")
    found = sharding.shard_rows(docs, limit).collect()
    assert len(found) == len(rows)
    held = defaultdict(list)
    for r in found:
        held[r.depth, r.prefix, r.part].append(r.n_bytes)
        assert r.n_bytes == len((dict(rows)[r.key] or "").encode())
    for (depth, prefix, _), sizes in held.items():
        assert sum(sizes) <= limit or len(sizes) == 1
        if 0 < depth < sharding.BITS:  # the bucket that it was split from was over the limit
            up = sum(r.n_bytes for r in found
                     if r.depth >= depth and r.prefix >> (r.depth - depth + 1) == prefix >> 1)
            assert up > limit
    sizes = {(r.depth, r.prefix, r.part): r.shard_bytes for r in found}
    assert all(sum(held[k]) == n for k, n in sizes.items())
    assert sharding.shard_rows(docs.limit(0), limit).count() == 0
    if limit == 1000:
        path = str(tmp_path / "shards")
        sharding.write_shards(docs, path, limit)
        back = spark.read.parquet(path)
        assert back.drop("_shard").columns == docs.columns and back.count() == len(rows)
        assert back.select("_shard").distinct().count() == len(held)


def test_copies_and_rows_without_bytes_are_dealt_by_number(spark, monkeypatch):
    """Also where chunks are small and the rows lie in many partitions; no window over one hash."""
    monkeypatch.setattr(sharding, "_CHUNK_BITS", 3)
    rows = [(None, "same text of 24 bytes ..")] * 700 + [(None, None)] * 500 + [(1, "")] * 90
    rows += [(2, "x" * 300)] * 9 + [(3, "y" * 900)] * 5 + [(i, "other") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    found = sharding.shard_rows(docs, max_bytes=800, max_rows=40)
    got = found.collect()
    assert Counter((r.key, r.n_bytes) for r in got) == Counter((k, len(t or "")) for k, t in rows)
    held = defaultdict(list)
    for r in got:
        held[r.depth, r.prefix, r.part].append(r)
    for shard in held.values():
        total = sum(r.n_bytes for r in shard)
        assert {r.shard_bytes for r in shard} == {total}
        assert len(shard) == 1 or (total <= 800 and len(shard) <= 40)
    assert 700 * 24 // 800 < sum(any(r.n_bytes == 24 for r in s) for s in held.values()) < 60
    fewer = sharding.shard_rows(docs.repartition(2), max_bytes=800, max_rows=40).collect()
    assert Counter(got) == Counter(fewer)


@pytest.mark.parametrize("limit", [3000, 10**6])
def test_shards_read_back(spark, limit, tmp_path):
    rows = [(i, "ä" * (i % 50), "x") for i in range(2000)] + [(5000, None, "x"), (None, "x" * 3000, None)]
    docs = spark.createDataFrame(rows + [(7000, "same row here", "y")] * 40,
                                 "doc_id long, text string, _Shard string")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, limit)
    found, want = sharding.read_shards(spark, path, docs.schema), sharding.shard_rows(docs, limit)
    assert found.dtypes == want.dtypes
    assert Counter(found.collect()) == Counter(want.collect())
    nothing = str(tmp_path / "nothing")
    sharding.write_shards(docs.limit(0), nothing, limit)
    assert sharding.read_shards(spark, nothing, docs.schema).count() == 0


def test_registered_shards_come_from_written_files(spark, sf_dir):
    found = queries.op10_extendible_shards(spark, sf_dir)
    assert all("/shards-" in f for f in found.inputFiles()) and found.inputFiles()
    want = sharding.shard_rows(read(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")
    assert found.columns == want.columns and Counter(found.collect()) == Counter(want.collect())
