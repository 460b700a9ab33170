"""Metrics: published confusion counts, ties, absent classes, MLlib's evaluator, brute force."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keepsake.operators import evaluate as ev

# Published confusion counts (TP, FN, FP, TN), accuracy, balanced accuracy, and per
# class and in all the printed precision, recall, F1 and support.
GOLDEN = [
    ((78, 27, 6, 555), 0.950450, 0.866081,
     {"0.0": (0.95, 0.99, 0.97, 561), "1.0": (0.93, 0.74, 0.83, 105),
      "avg / total": (0.95, 0.95, 0.95, 666)}),
    ((57, 25, 6, 579), 0.953523, 0.842433,
     {"0.0": (0.96, 0.99, 0.97, 585), "1.0": (0.90, 0.70, 0.79, 82),
      "avg / total": (0.95, 0.95, 0.95, 667)}),
    ((80, 34, 10, 710), 0.947242, 0.843932748538,
     {"0.0": (0.95, 0.99, 0.97, 720), "1.0": (0.89, 0.70, 0.78, 114),
      "avg / total": (0.95, 0.95, 0.94, 834)}),
    ((68, 21, 19, 559), 0.940030, 0.865586485751,
     {"0.0": (0.96, 0.97, 0.97, 578), "1.0": (0.78, 0.76, 0.77, 89),
      "avg / total": (0.94, 0.94, 0.94, 667)}),
]


def expand(spark, tp, fn, fp, tn):
    rows = [(1.0, 1.0)] * tp + [(1.0, 0.0)] * fn + [(0.0, 1.0)] * fp + [(0.0, 0.0)] * tn
    return spark.createDataFrame(rows, "label double, prediction double")


def values(df):
    return {r.metric: r.value for r in df.collect()}


@pytest.mark.parametrize("counts,accuracy,balanced,report", GOLDEN)
def test_published_reports(spark, counts, accuracy, balanced, report):
    scored = expand(spark, *counts)
    assert ev.accuracy(scored).first()[0] == pytest.approx(accuracy, abs=5e-7)
    assert ev.balanced_accuracy(scored).first()[0] == pytest.approx(balanced, abs=5e-7)
    printed = {
        r["class"]: (round(r.precision, 2), round(r.recall, 2), round(r.f1, 2), r.support)
        for r in ev.classification_report(scored).collect()
    }
    assert printed == report
    # The area under the curve of hard predictions is the balanced accuracy.
    area = ev.area_under_roc(scored, score="prediction").first()[0]
    assert area == pytest.approx(balanced, abs=5e-7)


def brute_force(rows):
    """Areas from all pairs and from every threshold."""
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    points, tp, fp = [], 0, 0
    for cut in sorted({s for _, s in rows}, reverse=True):
        tp += sum(1 for y, s in rows if y == 1 and s == cut)
        fp += sum(1 for y, s in rows if y == 0 and s == cut)
        points.append((tp / len(pos), tp / (tp + fp)))
    points = [(0.0, points[0][1]), *points]
    pr = sum((r1 - r0) * (p0 + p1) / 2 for (r0, p0), (r1, p1) in zip(points, points[1:]))
    return wins / (len(pos) * len(neg)), pr


def skewed_scores(kind, n, rng):
    if kind == "tied":
        return [rng.choice([0.1, 0.1, 0.1, 0.7]) for _ in range(n)]
    if kind == "near zero":
        return [10.0 ** -rng.uniform(0, 30) for _ in range(n)]
    if kind == "one hot score":
        return [0.5 if rng.random() < 0.4 else rng.random() for _ in range(n)]
    if kind == "all equal":
        return [0.25] * n
    if kind == "infinite":
        return [rng.choice([-float("inf"), float("inf"), rng.gauss(0, 1)]) for _ in range(n)]
    return [round(rng.gauss(0, 1), 1) for _ in range(n)]


@pytest.mark.parametrize(
    "kind", ["tied", "near zero", "one hot score", "all equal", "infinite", "rounded"]
)
@pytest.mark.parametrize("partitions", ["1", "2", "37"])
def test_areas_equal_brute_force(spark, kind, partitions):
    rng = random.Random(kind + partitions)
    rows = [(float(rng.random() < 0.3), s) for s in skewed_scores(kind, 400, rng)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        scored = spark.createDataFrame(rows, "label double, score double").repartition(5)
        found = values(ev.evaluate(scored, ("area_under_roc", "area_under_pr")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    roc, pr = brute_force(rows)
    assert found["area_under_roc"] == pytest.approx(roc, abs=1e-12)
    assert found["area_under_pr"] == pytest.approx(pr, abs=1e-12)


def test_areas_equal_the_evaluator_without_bins(spark):
    rng = random.Random(3)
    rows = [(float(rng.random() < 0.3), rng.random()) for _ in range(5000)]
    scored = spark.createDataFrame(rows, "label double, score double").repartition(8).cache()
    found = values(ev.evaluate(scored, ("area_under_roc", "area_under_pr")))
    for metric, name in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
        theirs = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="label", metricName=name, numBins=0
        ).evaluate(scored)
        assert found[metric] == pytest.approx(theirs, abs=1e-12)
    scored.unpersist()


def test_all_metrics_in_one_call(spark):
    scored = expand(spark, 3, 1, 2, 4).withColumn("score", F.col("prediction"))
    found = values(ev.evaluate(scored))
    assert list(found) == list(ev.METRICS)
    assert found["accuracy"] == pytest.approx(0.7)
    assert found["balanced_accuracy"] == pytest.approx((3 / 4 + 4 / 6) / 2)
    assert found["area_under_roc"] == pytest.approx((3 / 4 + 4 / 6) / 2)
    with pytest.raises(ValueError):
        ev.evaluate(scored, ("log_loss",))


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_absent_class_gives_null(spark, label):
    scored = spark.createDataFrame(
        [(label, 1.0, 0.9), (label, 0.0, 0.2)], "label double, prediction double, score double"
    )
    found = values(ev.evaluate(scored))
    assert found["accuracy"] == 0.5
    assert found["balanced_accuracy"] is None and found["area_under_roc"] is None
    assert found["area_under_pr"] == (None if label == 0.0 else 1.0)


def test_empty_table(spark):
    scored = spark.createDataFrame([], "label double, prediction double, score double")
    assert set(values(ev.evaluate(scored)).values()) == {None}


def test_class_never_predicted_has_precision_zero(spark):
    report = {r["class"]: r for r in ev.classification_report(expand(spark, 0, 3, 0, 7)).collect()}
    assert (report["1.0"].precision, report["1.0"].recall, report["1.0"].f1) == (0.0, 0.0, 0.0)
    assert report["1.0"].support == 3 and report["avg / total"].support == 10


def test_rows_are_not_left_out_in_silence(spark):
    unscored = spark.createDataFrame(
        [(1.0, 0.3), (0.0, None), (0.0, float("nan"))], "label double, score double"
    )
    with pytest.raises(ValueError, match="2 rows have no score"):
        ev.area_under_roc(unscored)
    odd = spark.createDataFrame([(2.0, 1.0), (None, 1.0)], "label double, prediction double")
    with pytest.raises(Exception, match="other than 0 and 1"):
        ev.balanced_accuracy(odd).collect()


def test_percent_accuracy(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (1, 1)], "a int, b int")
    assert ev.accuracy_percent(rows, F.col("a"), F.col("b")).first()[0] == 75.0


def test_listing(spark):
    scored = spark.createDataFrame(
        [(7, 1.0, 0.0, Vectors.dense([0.75, 0.25]), "x")],
        ["id", "label_index", "prediction", "probability", "other"],
    )
    listed = ev.listing(scored, ["id"], "label_index", probability="probability")
    assert listed.columns == ["id", "label", "prediction", "probability"]
    assert tuple(listed.first()) == (7, 1.0, 0.0, 0.25)
    with pytest.raises(ValueError):
        ev.listing(scored, ["id", "prediction"])


def test_curve_plan_keeps_scores_apart(spark):
    scored = spark.range(1000).select(
        (F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") / 7).alias("score")
    )
    found = ev.evaluate(scored, ("area_under_roc", "area_under_pr"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # The distinct scores are shuffled once for both sides of the join.
    assert final.count("ReusedExchange") == 1
    # Only range totals and final sums meet in one partition, never the scores.
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert part.split("HashAggregate(", 1)[0].count("FileScan") == 0
        assert "HashAggregate(keys=[range" in part[:200] or "HashAggregate(keys=[]" in part[:200]
