"""Settings, caps and refusals that results depend on."""

import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from keepsake.operators import evaluate as ev
from keepsake.operators import learners as ln
from keepsake.operators import profile as pf
from keepsake.sources.delimited import read_with_header


def test_linear_svc_stops_as_mllib_does(spark):
    assert ln.linear_svc().getTol() == LinearSVC().getTol() == 1e-6
    assert ln.linear_svc().getMaxIter() == LinearSVC().getMaxIter()
    assert ln.linear_svc(tol=1e-3, maxIter=7).getTol() == 1e-3


def test_weights_of_many_classes(spark):
    df = spark.range(1010).select((F.col("id") % 101).alias("label"))
    found = pf.with_class_weight(df, df, "label")
    assert found.columns == ["label", "weight"]
    assert {r.weight for r in found.collect()} == {1.0} and found.count() == 1010


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,10\n2,20\n")
    assert read_with_header(spark, str(tmp_path), {"y": "double"}).count() == 2
    (tmp_path / "b.csv").write_text("y,x\n30,3\n40,4\n")
    with pytest.raises(Exception, match="header"):
        read_with_header(spark, str(tmp_path), {"x": "double", "y": "double"}).collect()


@pytest.mark.parametrize("row", [(None, 1.0), (1.0, None)])
def test_rows_without_label_or_prediction_are_refused(spark, row):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), row], "label double, prediction double")
    for metric in (
        ev.accuracy(df),
        ev.accuracy_percent(df, df.prediction, df.label),
        ev.classification_report(df),
        ev.evaluate(df, ("accuracy",)),
    ):
        with pytest.raises(Exception):
            metric.collect()


def test_infinity_spoils_only_its_own_row(spark):
    rows = [(float("inf"), None), (1.0, 1.0), (2.0, 2.0), (3.0, 4.5), (4.0, float("-inf"))]
    df = spark.createDataFrame(rows, "x double, y double")
    matrix = {(r.x, r.y): r.r for r in pf.correlation_matrix(df, ["x", "y"]).collect()}
    listed = {r.feature: r.r for r in pf.correlations(df, "y", ["x"]).collect()}
    assert matrix["x", "y"] == pytest.approx(0.9707, abs=1e-4)
    assert listed["x"] == pytest.approx(matrix["x", "y"])


@pytest.mark.parametrize("area", [ev.area_under_roc, ev.area_under_pr])
def test_one_area_reads_its_points_once(spark, tmp_path, area):
    path = str(tmp_path / "scored")
    spark.range(500).selectExpr("cast(id % 2 as double) label", "id % 37 / 37 score").write.parquet(path)
    found = area(spark.read.parquet(path))
    found.collect()  # only a plan that has run shows what it reuses
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
