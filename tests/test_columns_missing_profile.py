import math
import statistics

import pytest
from pyspark.sql import functions as F

from keepsake.operators import columns as cols
from keepsake.operators import missing as ms
from keepsake.operators import profile as pf

NAN = float("nan")


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b c", "d"])
    assert cols.keep(df, ["d", "b c"]).columns == ["d", "b c"]
    assert cols.drop(df, ["b c"]).columns == ["a", "d"]
    assert cols.names_except(df, {"a"}) == ["b c", "d"]
    assert cols.rename(df, {"b c": "b"}).columns == ["a", "b", "d"]
    replaced = cols.replace(df, {"a": F.col("a") + 10})
    assert replaced.columns == df.columns and replaced.first().a == 11
    with pytest.raises(ValueError):
        cols.drop(df, ["typo"])


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1.0, None, "x", None), (3.0, 5.0, None, None), (NAN, 7.0, "y", None),
            (None, NAN, "y", None)]
    return spark.createDataFrame(rows, "a double, b double, t string, none double")


def test_null_audit(gaps):
    found = {r.column: (r.n_rows, r.n_missing) for r in ms.null_audit(gaps).collect()}
    assert found == {"a": (4, 2), "b": (4, 2), "t": (4, 1), "none": (4, 4)}
    assert [r.column for r in ms.null_audit(gaps, ["b"]).collect()] == ["b"]


def test_mean_imputer_fills_null_and_nan(gaps):
    filled = ms.mean_imputer(["a", "b"]).fit(gaps).transform(gaps).collect()
    assert [r.a for r in filled] == [1.0, 3.0, 2.0, 2.0]
    assert [r.b for r in filled] == [6.0, 5.0, 7.0, 6.0]


def test_columns_without_values(gaps):
    assert ms.columns_without_values(gaps, ["a", "none", "b"]) == ["none"]


def test_fill_zero(gaps):
    assert [r.a for r in ms.fill_zero(gaps).collect()] == [1.0, 3.0, 0.0, 0.0]
    one = ms.fill_zero(gaps, ["a"])
    assert one.where("b IS NULL OR isnan(b)").count() == 2


def test_column_stats(gaps):
    found = {r.column: r for r in pf.column_stats(gaps, ["a", "none"]).collect()}
    assert (found["a"].n, found["a"].mean, found["a"].std_pop) == (2, 2.0, 1.0)
    assert found["a"].std_samp == pytest.approx(math.sqrt(2))
    assert (found["none"].n, found["none"].mean) == (0, None)


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [
        (float(i), None if i % 4 == 0 else float(i * i % 11), 2.0, float(i % 2))
        for i in range(40)
    ]
    return spark.createDataFrame(rows, "x double, y double, flat double, target double").repartition(4)


def pearson(rows):
    xs, ys = zip(*rows)
    return statistics.correlation(xs, ys)


def test_correlations_use_complete_pairs(pairs):
    rows = pairs.collect()
    found = {r.feature: r.r for r in pf.correlations(pairs, "target", ["x", "y", "flat"]).collect()}
    assert found["target"] == pytest.approx(1.0)
    assert found["flat"] is None
    assert found["x"] == pytest.approx(pearson([(r.x, r.target) for r in rows]))
    assert found["y"] == pytest.approx(pearson([(r.y, r.target) for r in rows if r.y is not None]))


def test_top_correlations(pairs):
    top = pf.top_correlations(pairs, "target", ["x", "y", "flat"], rows=3)
    assert top.first().feature == "target"
    assert top.count() == 3
    assert "flat" not in [r.feature for r in top.collect()]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    without = pf.top_correlations(pairs, "target", ["x", "y", "flat"], include_target=False)
    assert [r.feature for r in without.collect()][-1] == "flat"


def test_correlation_matrix(pairs):
    names = ["x", "y", "flat"]
    found = {(r.x, r.y): r.r for r in pf.correlation_matrix(pairs, names).collect()}
    assert len(found) == 9
    assert found["x", "y"] == found["y", "x"] is not None
    assert found["x", "x"] == pytest.approx(1.0) and found["flat", "flat"] is None


def test_matrix_equals_the_target_correlations(spark):
    """Gaps, a huge offset, a column that is constant only where the other is present."""
    rows = spark.range(3000).select(
        (F.xxhash64("id") % 1000 + 1_000_000_000).cast("double").alias("far"),
        F.when(F.col("id") % 3 != 0, (F.hash("id") % 7).cast("double")).alias("gappy"),
        F.when(F.col("id") % 3 == 1, 4.25).otherwise(F.rand(5)).alias("flat_there"),
        F.when(F.col("id") % 3 == 1, F.rand(6)).otherwise(NAN).alias("there"),
        F.lit(None).cast("double").alias("none"),
        F.lit(0.1).alias("flat"),
        (F.col("id") % 2).alias("target"),
    ).repartition(7).cache()
    found = {(r.x, r.y): r.r for r in pf.correlation_matrix(rows, rows.columns).collect()}
    assert len(found) == 49
    assert found["flat_there", "there"] is None and found["flat", "far"] is None
    assert all(found["none", c] is None for c in rows.columns)
    for column in rows.columns:
        for r in pf.correlations(rows, column, rows.columns).collect():
            if found[r.feature, column] is not None:
                assert found[r.feature, column] == pytest.approx(r.r, abs=1e-9)
    rows.unpersist()


def test_matrix_of_no_rows(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert all(r.r is None for r in pf.correlation_matrix(empty, ["x", "y"]).collect())


def test_category_counts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", None)], "t string, c int")
    found = {(r.column, r.value): r.n for r in pf.category_counts(df, ["t", "c"]).collect()}
    assert found == {("t", "a"): 2, ("t", "b"): 1, ("c", "1"): 2}


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "k string")
    found = {r.label: (r.n, r.weight) for r in pf.class_weights(df, "k").collect()}
    assert found == {"a": (6, pytest.approx(8 / 12)), "b": (2, 2.0)}
    weighted = pf.with_class_weight(df, df, "k")
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(8.0)
    unseen = spark.createDataFrame([("c",)], "k string")
    assert pf.with_class_weight(unseen, df, "k").first().weight is None
    joined = pf.with_class_weight(df, df, "k", literals=1)
    assert sorted(joined.collect()) == sorted(weighted.collect())
