"""Indices of wide columns, scoring with saved models, calibrated margins, mixed headers, and
whether a trained network stands at an optimum."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keepsake import __main__ as cli
from keepsake.functions.scores import element
from keepsake.operators import calibrate, ranks
from keepsake.operators import features as ft
from keepsake.operators import learners as ln
from keepsake.plans import derived, scoring, studies
from keepsake.plans.queries import TEXT_FEATURES, quality_rows
from keepsake.session import new_shared_path
from keepsake.sources import delimited

VALUES = ["b", "a", "b", "c", None, "a", "é", "B", "", "a b", "c", "c"] + [f"v{i % 40}" for i in range(90)]


@pytest.fixture(scope="module")
def named(spark):
    rows = [(i, v) for i, v in enumerate(VALUES)]
    return spark.createDataFrame(rows, "id long, v string").repartition(5)


@pytest.mark.parametrize("order", ranks.ORDERS)
def test_tables_give_the_indices_of_lists(spark, named, order, tmp_path):
    other = spark.createDataFrame([(1, "a"), (2, None), (3, "new"), (4, "v7")], "id long, v string")
    wide = ranks.WideIndexer(inputCol="v", outputCol="i", order=order, few=0).fit(named)
    listed = ranks.WideIndexer(inputCol="v", outputCol="i", order=order, few=1000).fit(named)
    assert isinstance(wide, ranks.WideIndexerModel)
    assert not isinstance(listed, ranks.WideIndexerModel)
    for df in (named, other):
        assert sorted(wide.transform(df).select("id", "i").collect()) == sorted(
            listed.transform(df).select("id", "i").collect()
        )
    path = str(tmp_path / order)
    PipelineModel([wide]).save(path)
    again = PipelineModel.load(path).transform(other)
    assert sorted(again.collect()) == sorted(wide.transform(other).collect())


def test_ranks_of_nothing_and_of_one_frequent_value(spark):
    empty = spark.createDataFrame([], "v string")
    assert ranks.rank_values(empty, "v").count() == 0
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "x").otherwise(F.col("id").cast("string")).alias("v"))
    found = ranks.rank_values(hot, "v").orderBy("index").collect()
    assert found[0].value == "x" and [r["index"] for r in found] == list(range(2001))
    assert [r.value for r in found[1:]] == sorted(str(i) for i in range(3000) if i % 3)
    with pytest.raises(ValueError, match="order"):
        ranks.rank_values(hot, "v", "size")


def test_fitting_wide_collects_range_sizes_only(named):
    """The plan that numbers values has no single partition and no collected list."""
    plan = ranks.rank_values(named, "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_wide_classes_as_vectors(spark, named):
    named = named.where("v IS NULL OR v <> ''")  # MLlib has no vector place without a name
    known = named.where("v IS NOT NULL")
    both = []
    for stages in (ft.label_one_hot("v", "hot"), ft.label_one_hot_wide("v", "hot", few=0)):
        out = Pipeline(stages=stages).fit(known).transform(known)
        both.append(sorted(out.select("id", vector_to_array("hot")).collect()))
    assert both[0] == both[1]
    few, wide = (
        Pipeline(stages=ft.label_one_hot_wide("v", "hot", few=n)).fit(named) for n in (0, 1000)
    )
    other = spark.createDataFrame([("new",), (None,), ("a",)], "v string")
    for model in (few, wide):
        sums = [sum(r[0]) for r in model.transform(other).select(vector_to_array("hot")).collect()]
        assert sums == [0, 0, 1]


def test_index_in_place_with_wide_and_narrow_columns(named):
    df = named.withColumn("w", F.concat("v", F.lit("!")))
    assert sorted(ft.index_in_place(df, df, ["v", "w"], few=0).collect()) == sorted(
        ft.index_in_place(df, df, ["v", "w"]).collect()
    )


@pytest.mark.parametrize("study", ["churn_forest", "renewal_linear"])
def test_saved_model_scores_as_the_fit_does(spark, sf_dir, study, tmp_path):
    write = derived.write_churn_lines if study.startswith("churn") else derived.write_renewal_csv
    path, model = write(spark, sf_dir), str(tmp_path / "model")
    result = studies.run_study(spark, study, path)
    scoring.save_model(result, study, model)
    scorer = scoring.Scorer.load(spark, model)
    chance = element(F.col("probability"), 1)
    want = sorted(r[0] for r in result.scored.select(chance).collect())
    again = scorer.score(result.test.drop("label"))
    assert sorted(r[0] for r in again.select(chance).collect()) == want
    rows = scorer.read(spark, path)
    assert scorer.listing(rows).count() == rows.count()
    features = scorer.features.names
    with pytest.raises(ValueError, match=f"{features[2]} is missing"):
        scorer.score(rows.drop(features[2]))
    with pytest.raises(ValueError, match=f"{features[1]} is string, not .*more is not a feature"):
        scorer.score(rows.withColumn(features[1], F.lit("1")).withColumn("more", F.lit(1)))
    with pytest.raises(ValueError, match="own.*prediction"):
        scorer.listing(rows.withColumnRenamed(features[0], features[0]), ["prediction"])
    result.release()


def test_command_line_scores_a_file_without_labels(spark, sf_dir, tmp_path):
    path, out = derived.write_churn_csv(spark, sf_dir), str(tmp_path / "fit")
    cli.main(["churn_linear", path, out])
    unmarked = str(tmp_path / "new")
    raw = delimited.read_with_header(spark, path).drop("Churn?")
    raw.write.csv(unmarked, header=True)
    cli.main(["score", f"{out}/model", unmarked, str(tmp_path / "scored")])
    listed = spark.read.parquet(str(tmp_path / "scored" / "listing"))
    assert listed.count() == raw.count() and listed.where("probability IS NULL").count() == 0
    fitted = spark.read.parquet(f"{out}/listing").select("Day Mins", "Day Calls", "probability")
    assert fitted.exceptAll(listed.select(*fitted.columns)).count() == 0
    with pytest.raises(ValueError, match="no model"):
        scoring.Scorer.load(spark, _other_model(spark, tmp_path))


def _other_model(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([("unknown", "l", "{}")], scoring._SAVED).write.json(f"{path}/study")
    return path


def _plain_platt(x, y):
    """The same optimum by Newton steps on arrays."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, math.log((n1 + 1) / (n0 + 1))
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a * x + b)))
        e, w = p - t, p * (1 - p)
        h = np.array([[(w * x * x).sum(), (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-12 * np.eye(2), [(e * x).sum(), e.sum()])
        loss = lambda a, b: (np.logaddexp(0, a * x + b) - t * (a * x + b)).sum()
        size = 1.0
        while loss(a - size * step[0], b - size * step[1]) > loss(a, b) and size > 1e-9:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
    return a, b


def test_sigmoid_against_a_plain_fit(spark):
    rng = np.random.default_rng(4)
    for x, y in (
        (rng.normal(size=500), None), (rng.normal(size=60) * 50, None),
        (np.array([-2.0, -1, 1, 2]), np.array([0.0, 0, 1, 1])), (np.array([1.0]), np.array([1.0])),
    ):
        if y is None:
            y = (rng.random(len(x)) < 1 / (1 + np.exp(-1.5 * x + 0.4))).astype(float)
        df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "m double, y double")
        a, b = calibrate.fit_sigmoid(df, "m", "y")
        p, q = _plain_platt(x, y)
        assert np.allclose(a * x + b, p * x + q, atol=1e-3)
    bad = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 0.0)], "m double, y double")
    with pytest.raises(ValueError, match="3 rows"):
        calibrate.fit_sigmoid(bad, "m", "y")
    with pytest.raises(ValueError, match="no rows"):
        calibrate.fit_sigmoid(bad.limit(0), "m", "y")


def test_calibrated_classifier(spark, sf_dir, tmp_path):
    rows = quality_rows(spark, sf_dir).cache()
    model = ln.calibrated_svc(rows, TEXT_FEATURES, ["text_hash"], maxIter=20)
    model.save(str(tmp_path / "svc"))
    scored = PipelineModel.load(str(tmp_path / "svc")).transform(rows)
    found = scored.select(
        vector_to_array("rawPrediction")[1].alias("m"), element(F.col("probability"), 1).alias("p"),
        vector_to_array("probability").alias("both"), "prediction",
    ).orderBy("m").collect()
    assert all(a.p <= b.p for a, b in zip(found, found[1:]))
    assert all(abs(sum(r.both) - 1) < 1e-12 and (r.prediction == 1) == (r.m > 0) for r in found)


def test_strength_of_an_inverse(spark):
    assert ln.penalty_strength(spark.range(50), 2.0) == 0.01
    for rows, inverse in ((0, 1.0), (5, 0.0)):
        with pytest.raises(ValueError, match="inverse"):
            ln.penalty_strength(spark.range(rows), inverse)


def _folder(spark, files):
    path = new_shared_path(spark, "mixed")
    for lines in files:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
            "append"
        ).text(path)
    return path


def test_files_with_headers_of_their_own(spark):
    path = _folder(spark, [["a,b", "1,x", '2,"y,z"'], ["b,a", "w,3"], ["a,b", "4,"], ["a,b"]])
    types = {"a": "double", "b": "string"}
    found = delimited.read_with_header(spark, path, types, headers="each").collect()
    assert sorted(map(tuple, found)) == [(1.0, "x"), (2.0, "y,z"), (3.0, "w"), (4.0, None)]
    everything = delimited.read_with_header(spark, path, headers="each")
    assert sorted(everything.columns) == ["a", "b"] and everything.count() == 4
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_with_header(spark, path, types).collect()


def test_header_without_a_wanted_column_is_named(spark):
    path = _folder(spark, [["a,b", "1,x"], ["a,c", "2,y"]])
    types = {"a": "double", "b": "string"}
    with pytest.raises(ValueError, match="part-.*has no column b"):
        delimited.read_with_header(spark, path, types, headers="each")
    found = delimited.read_with_header(spark, path, types, headers="each", optional=["b"]).collect()
    assert sorted(map(tuple, found), key=lambda r: r[0]) == [(1.0, "x"), (2.0, None)]
    with pytest.raises(ValueError, match="twice"):
        delimited.read_with_header(spark, _folder(spark, [["a,a", "1,2"]]), headers="each")
    with pytest.raises(ValueError, match="headers"):
        delimited.read_with_header(spark, path, headers="any")


def test_trained_network_stands_at_an_optimum(spark):
    """The loss of a fitted network over its table, by plain arrays, and its numeric gradient."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] * x[:, 1] + 0.5 * rng.normal(size=300) > 0).astype(float)
    df = spark.createDataFrame(
        [(Vectors.dense(row), label) for row, label in zip(x.tolist(), y.tolist())],
        ["features", "label"],
    )
    model = ln.network("renewal_small", 3, label="label", blockSize=1, maxIter=800, tol=1e-10).fit(df)
    layers, weights = [3, 3, 3, 2], np.array(model.weights)

    def loss(flat):
        at, h = 0, x
        for k, (n, m) in enumerate(zip(layers, layers[1:])):
            w = flat[at : at + n * m].reshape(n, m).T  # columns first
            b = flat[at + n * m : at + n * m + m]
            at += n * m + m
            h = h @ w.T + b
            if k < len(layers) - 2:
                h = 1 / (1 + np.exp(-h))
        z = h - h.max(1, keepdims=True)
        return -(z[np.arange(len(y)), y.astype(int)] - np.log(np.exp(z).sum(1))).mean()

    chance = np.array([r[0] for r in model.transform(df).select(element(F.col("probability"), 1)).collect()])
    plain = -np.mean(np.where(y == 1, np.log(chance), np.log1p(-chance)))
    assert abs(loss(weights) - plain) < 1e-8  # the same network
    step = 1e-5
    gradient = [
        (loss(weights + step * e) - loss(weights - step * e)) / (2 * step)
        for e in np.eye(len(weights))
    ]
    start = [
        (loss(w0 + step * e) - loss(w0 - step * e)) / (2 * step)
        for w0 in [rng.normal(size=len(weights))] for e in np.eye(len(weights))
    ]
    assert np.linalg.norm(gradient) < 0.01 * np.linalg.norm(start)
