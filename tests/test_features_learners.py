import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keepsake import constants as C
from keepsake.operators import features as ft
from keepsake.operators import learners as ln
from keepsake.operators import profile as pf


def arrays(df, column):
    return [list(r.v) for r in df.select(vector_to_array(F.col(column)).alias("v")).collect()]


def test_assemble_takes_booleans_and_refuses_gaps(spark):
    df = spark.createDataFrame([(True, 2.0), (False, None)], "b boolean, x double")
    whole = ft.assemble(["x", "b"]).transform(df.where("x IS NOT NULL"))
    assert arrays(whole, "features") == [[2.0, 1.0]]
    with pytest.raises(Exception):
        ft.assemble(["x", "b"]).transform(df).collect()


def test_index_by_frequency(spark):
    df = spark.createDataFrame([(x,) for x in "bbaac"], "t string")
    model = ft.index_by_frequency(["t"]).fit(df)
    assert list(model.labelsArray[0]) == ["a", "b", "c"]  # equal counts in alphabetical order
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "t string")
    assert [r.t_index for r in model.transform(new).collect()] == [0.0, 3.0, 3.0]


def test_two_columns_are_indexed_and_encoded_in_place(spark):
    df = spark.createDataFrame(
        [(1, "x", "p"), (2, "y", "q"), (3, "x", "q"), (4, "x", "q")], "id int, s string, t string"
    )
    indexed = ft.index_in_place(df, df, ["s", "t"])
    assert indexed.columns == ["id", "s", "t"]
    assert [tuple(r) for r in indexed.orderBy("id").collect()] == [
        (1, 0.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 0.0), (4, 0.0, 0.0)
    ]
    numbers = df.select(
        "id", (F.col("s") == "y").cast("double").alias("s"),
        (F.col("t") == "p").cast("double").alias("t"),
    )
    kept = ft.one_hot_in_place(numbers, numbers, ["s", "t"], drop_last=False).orderBy("id")
    assert kept.columns == ["id", "s", "t"]
    assert arrays(kept, "s") == [[1, 0], [0, 1], [1, 0], [1, 0]]
    assert arrays(kept, "t") == [[0, 1], [1, 0], [1, 0], [1, 0]]
    dropped = ft.one_hot_in_place(numbers, numbers, ["s", "t"]).orderBy("id")
    assert arrays(dropped, "s") == [[1], [0], [1], [1]]


def test_label_one_hot_is_in_alphabetical_order(spark):
    df = spark.createDataFrame([("True.",), ("True.",), ("False.",)], "y string")
    hot = Pipeline(stages=ft.label_one_hot("y", "hot")).fit(df).transform(df)
    assert arrays(hot, "hot") == [[0, 1], [0, 1], [1, 0]]


@pytest.mark.parametrize("rows", ["TTTF", "FFFT"])
def test_positive_class_does_not_move_with_its_frequency(spark, rows):
    text = {"T": "True.", "F": "False."}
    df = spark.createDataFrame([(text[x],) for x in rows], "label string")
    indexed = ft.label_index("label", C.CHURN_LABELS, "i").transform(df)
    assert [r.i for r in indexed.collect()] == [float(x == "T") for x in rows]
    back = ft.label_text("i", C.CHURN_LABELS, "text").transform(indexed)
    assert [r.text for r in back.collect()] == [text[x] for x in rows]
    odd = spark.createDataFrame([("Maybe",)], "label string")
    with pytest.raises(Exception):
        ft.label_index("label", C.CHURN_LABELS, "i").transform(odd).collect()


def test_categories_are_found_and_unseen_values_kept(spark):
    rows = [(Vectors.dense([i % 10, i % 11]),) for i in range(50)]
    df = spark.createDataFrame(rows, ["v"])
    model = ft.detect_categories("v", "i").fit(df)
    assert set(model.categoryMaps) == {0}
    new = spark.createDataFrame([(Vectors.dense([99.0, 99.0]),)], ["v"])
    assert arrays(model.transform(new), "i") == [[10.0, 99.0]]
    assert C.FOREST_BINS >= C.MAX_CATEGORIES + 1


@pytest.mark.parametrize("spread,deviation", [("pop", 2.0), ("sample", (16 / 3) ** 0.5)])
def test_standardize(spark, spread, deviation):
    df = spark.createDataFrame([(Vectors.dense([x, 5.0]),) for x in (1, 1, 5, 5)], ["v"])
    both = ft.standardize("v", "s", spread=spread).fit(df).transform(df)
    assert arrays(both, "s")[0] == pytest.approx([-2 / deviation, 0.0])
    only_scaled = ft.standardize("v", "s", center=False, spread=spread).fit(df).transform(df)
    assert arrays(only_scaled, "s")[0][0] == pytest.approx(1 / deviation)
    centered = ft.standardize("v", "s", scale=False, spread=spread).fit(df).transform(df)
    assert arrays(centered, "s") == [[-2.0, 0.0], [-2.0, 0.0], [2.0, 0.0], [2.0, 0.0]]


def test_scaling_is_learnt_from_the_fitted_rows_only(spark):
    train = spark.createDataFrame([(Vectors.dense([x]),) for x in (0, 2)], ["v"])
    test = spark.createDataFrame([(Vectors.dense([101.0]),)], ["v"])
    scaled = arrays(ft.standardize("v", "s").fit(train).transform(test), "s")
    assert scaled == [pytest.approx([100.0])]


def test_to_dense(spark):
    df = spark.createDataFrame([(Vectors.sparse(2, {0: 1.0}),)], ["v"])
    dense = ft.to_dense(df, "v").first().v
    assert type(dense).__name__ == "DenseVector" and list(dense) == [1.0, 0.0]


COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def learnable(spark):
    """An unequal, learnable label with a missing cell here and there."""
    df = spark.range(400).select(
        "id",
        F.when(F.col("id") % 50 != 7, (F.hash("id") % 100).cast("double")).alias("a"),
        (F.xxhash64("id") % 50).cast("double").alias("b"),
        (F.col("id") % 4).cast("double").alias("c"),
    )
    label = F.when(F.coalesce("a", F.lit(0.0)) + F.col("b") > 25, "yes!").otherwise("no!")
    return df.withColumn("label", label).cache()


LABELS = ("no!", "yes!")
LEARNERS = {
    "forest": (lambda: ln.forest("churn"), {"categories": True}),
    "small forest": (lambda: ln.forest("renewal"), {"scaling": "center"}),
    "balanced forest": (lambda: ln.forest("renewal", weight="weight"), {}),
    "logistic": (lambda: ln.logistic(), {"scaling": "standard"}),
    "l1": (lambda: ln.logistic("l1", weight="weight"), {"scaling": "standard"}),
    "l2": (lambda: ln.logistic("l2", weight="weight"), {"scaling": "standard"}),
    "svc": (lambda: ln.linear_svc(), {"scaling": "standard"}),
    **{
        f"network {shape}": (lambda shape=shape: ln.network(shape, 3), {"scaling": "standard"})
        for shape in C.NETWORK_HIDDEN
    },
}


@pytest.mark.parametrize("name", LEARNERS)
def test_learner(spark, tmp_path, learnable, name):
    make, options = LEARNERS[name]
    rows = pf.with_class_weight(learnable, learnable, "label")
    stages = ln.classification_stages(make(), COLUMNS, LABELS, impute=True, **options)
    model = stages.fit(rows)
    scored = model.transform(learnable)

    def listed(df):
        return {r.id: (r.prediction, r.predicted_label) for r in df.collect()}

    found = listed(scored)
    assert len(found) == 400
    assert set(found.values()) <= {(0.0, "no!"), (1.0, "yes!")}
    right = scored.where(F.col("predicted_label") == F.col("label")).count()
    majority = max(r.n for r in pf.class_weights(learnable, "label").collect())
    assert right > majority
    if "probability" in scored.columns:
        for p in arrays(scored, "probability"):
            assert sum(p) == pytest.approx(1.0)

    assert listed(stages.fit(rows).transform(learnable)) == found  # the same seed again
    path = str(tmp_path / "model")
    model.save(path)
    assert listed(PipelineModel.load(path).transform(learnable)) == found


def test_settings():
    churn, renewal = ln.forest("churn"), ln.forest("renewal")
    assert [x.getNumTrees() for x in (churn, renewal)] == [15, 5]
    assert {(x.getMaxDepth(), x.getMaxBins(), x.getImpurity()) for x in (churn, renewal)} == {
        (10, 30, "gini")
    }
    shapes = {s: ln.network(s, 17).getLayers() for s in C.NETWORK_HIDDEN}
    assert shapes["churn_wide"] == [17, 50, 2]
    assert shapes["churn_deep"] == [17, 50, 50, 50, 50, 2]
    assert shapes["churn_custom"] == [17, 50, 50, 50, 2]
    assert ln.network("renewal_pair", 10).getLayers() == [10, 4, 4, 2]
    assert ln.network("renewal_small", 10).getLayers() == [10, 3, 3, 2]
    assert ln.logistic("l1").getElasticNetParam() == 1.0
    assert ln.logistic("l2").getElasticNetParam() == 0.0 and ln.logistic("l2").getRegParam() > 0
    assert ln.logistic().getRegParam() == 0.0


def test_scaled_categories_are_refused():
    with pytest.raises(ValueError):
        ln.classification_stages(ln.forest("churn"), COLUMNS, scaling="center", categories=True)
