"""The pipeline's stages, each on what the one before kept, and the queries against their SQL."""

import pytest

import corpus_pipeline
from keepsake.llm.oracle import ORACLE
from keepsake.llm.queries import QUERIES
from keepsake.llm.tables import read, stored
from tests.compare import connect, differences
from tests.llm.test_group_operators import roots, shingles, water, words


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) == []


def test_stages(spark, sf_dir):
    docs, seen = read(spark, sf_dir, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, sf_dir), name)
        seen.append((name, before, docs))
    for _, _, after in seen[:-1]:
        assert after.columns == columns

    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    _, before, after = seen[0]
    labels = {r.doc_id: r.quality for r in read(spark, sf_dir, "labels").collect()}
    gone = set(texts(before)) - set(texts(after))
    assert gone and not any(labels.get(d) for d in gone)

    _, before, after = seen[1]
    sets = {d: shingles(t) for d, t in texts(before).items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert set(texts(after)) == set(roots(sets, links).values())

    _, before, after = seen[2]
    items = [words(r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    inside = lambda t: any(" ".join(i) in " ".join(words(t)) for i in items)
    assert not any(inside(t) for t in texts(after).values())
    assert {d for d, t in texts(before).items() if inside(t)} <= set(texts(before)) - set(texts(after))

    _, before, after = seen[3]
    sizes, taken = {}, {}
    for r in before.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    for r in after.collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
    longest = max(len(words(t)) for t in texts(before).values())
    assert all(abs(taken.get(s, 0) - t) <= longest for s, t in water(sizes).items())

    _, before, after = seen[4]
    assert after.count() == before.count()
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in before.collect())


DOCUMENTS = [
    (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "b"), (None, "no id here", "en", "a"),
    (4, "the and of some long text " * 20_000, "en", "a"), (5, "same text", "en", None),
    (5, "same text", "en", None), (6, "same text", "de", "b"), (None, None, None, None),
    (-9, "🎉 naïve text", None, "c"),
]


@pytest.mark.parametrize("rows", [DOCUMENTS, []])
def test_pipeline_of_odd_and_empty_tables(spark, rows, tmp_path):
    """With columns that are named like those which the stages make, and without any label."""
    folder = str(tmp_path)
    extra = "key string, `Size` int, n_bytes long, score double, `class` int, part string"
    docs = spark.createDataFrame(
        [(*r, "k", 1, 2, 0.5, 3, "p") for r in rows],
        f"doc_id long, text string, lang string, source string, {extra}",
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    items = [(1, "the items of no document at all"), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    kept = read(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, folder), name)
        assert kept.dtypes == docs.dtypes, name
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in kept.collect())
    ids = {r.doc_id for r in found}
    assert ids <= {r[0] for r in rows} and not {5, 6} <= ids
    assert bool(found) == bool(rows)
