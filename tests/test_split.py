import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keepsake.operators import split as sp


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("divide", [sp.split, sp.split_exact])
def test_disjoint_complete_and_independent_of_partitions(spark, divide):
    df = spark.range(3000)
    train, test = divide(df, ["id"], 0.2)
    assert sorted(ids(train) + ids(test)) == list(range(3000))
    for other in (df.repartition(13), df.orderBy(F.desc("id")), df.coalesce(1)):
        assert ids(divide(other, ["id"], 0.2)[1]) == ids(test)


def test_hash_split_is_near_its_share_and_seeded(spark):
    df = spark.range(10_000)
    test = ids(sp.split(df, ["id"], 0.2)[1])
    assert abs(len(test) - 2000) < 200
    assert ids(sp.split(df, ["id"], 0.2, seed=8)[1]) != test
    assert ids(sp.split(df, ["id"], 0.0)[1]) == [] and ids(sp.split(df, ["id"], 1.0)[0]) == []


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(n=st.integers(0, 300), share=st.sampled_from([0.0, 0.1, 0.2, 0.25, 0.3, 0.999, 1.0]),
       seed=st.integers(0, 5))
def test_exact_size(spark, n, share, seed):
    train, test = sp.split_exact(spark.range(n), ["id"], share, seed)
    assert test.count() == math.ceil(n * share)
    assert train.count() == n - math.ceil(n * share)


def test_default_exact_share_is_a_quarter_rounded_up(spark):
    assert sp.split_exact(spark.range(3333), ["id"])[1].count() == 834


def test_exact_size_when_keys_repeat(spark, monkeypatch):
    """One key holds most rows; the rest of the row tells its rows apart."""
    df = spark.range(2000).select("id", (F.col("id") % 10 == 0).cast("int").alias("key"))
    for share in (0.2, 0.5, 0.9):
        train, test = sp.split_exact(df, ["key"], share)
        assert test.count() == math.ceil(2000 * share)
        assert sorted(ids(train) + ids(test)) == list(range(2000))


def test_equal_rows_share_a_side(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("id"))
    train, test = sp.split(df, ["id"], 0.5)
    assert train.count() + test.count() == 900
    assert not set(ids(train)) & set(ids(test))


@pytest.mark.parametrize("distinct", [1, 3, 10])
def test_exact_size_when_whole_rows_repeat(spark, distinct):
    df = spark.range(1000).select((F.col("id") % distinct).alias("id"), F.lit("x").alias("text"))
    train, test = sp.split_exact(df, ["id", "text"], 0.25)
    assert test.columns == train.columns == df.columns
    assert (test.count(), train.count()) == (250, 750)
    assert sorted(ids(train) + ids(test)) == sorted(ids(df))
    assert len(set(ids(train)) & set(ids(test))) <= 1


def test_narrowing_reaches_the_last_hash(spark, monkeypatch):
    """The search gives the same split however few hashes it may sort at the end."""
    df = spark.range(5000)
    expected = ids(sp.split_exact(df, ["id"], 0.3)[1])
    monkeypatch.setattr(sp, "_SORTABLE", 1)
    monkeypatch.setattr(sp, "_DIGITS_PER_PASS", 1)
    assert ids(sp.split_exact(df, ["id"], 0.3)[1]) == expected


def test_null_keys_have_a_side(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "id int, key string")
    train, test = sp.split(df, ["key"], 0.5)
    assert sorted(ids(train) + ids(test)) == [1, 2, 3]


def test_no_shuffle(spark):
    for divide in (sp.split, sp.split_exact):
        for part in divide(spark.range(100), ["id"], 0.2):
            assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()


def test_exact_split_of_tied_rows_with_vectors(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(1, Vectors.dense([1.0, float(i % 3)])) for i in range(30)]
    rows += [(1, Vectors.sparse(2, [0], [1.0]))] * 10  # equal to every third dense one
    df = spark.createDataFrame(rows, ["k", "v"]).repartition(6)
    train, test = sp.split_exact(df, ["k"], 0.3)
    values = lambda t: sorted(tuple(r.v.toArray()) for r in t.collect())
    assert test.count() == 12 and train.count() == 28
    assert sorted(values(train) + values(test)) == values(df)
    again = sp.split_exact(df.repartition(2), ["k"], 0.3)
    assert [values(t) for t in again] == [values(train), values(test)]


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
@pytest.mark.parametrize("divide", [sp.split, sp.split_exact])
def test_hashes_that_are_there_are_not_made_again(spark, monkeypatch, divide, share):
    """Equal keys, nulls among them, and equal rows fall as they do without the column."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("key"), (F.col("id") % 5).alias("x")
    )
    found = lambda part: sorted(part.collect(), key=str)
    wanted = [found(part) for part in divide(rows, ["key"], share, 3)]
    hashed = rows.withColumn("the hash", sp.key_hash(["key"], 3)).persist()
    monkeypatch.setattr(sp, "key_hash", lambda *_: F.raise_error(F.lit("made again")))
    parts = divide(hashed, ["key"], share, 3, hashed="the hash")
    assert [part.columns for part in parts] == [["key", "x"]] * 2
    assert [found(part) for part in parts] == wanted
    hashed.unpersist()
