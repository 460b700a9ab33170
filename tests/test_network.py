"""Networks trained by chunks of rows, against MLlib's own training."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from keepsake.operators import learners as ln
from keepsake.operators import network
from keepsake.plans.studies import STUDIES

INPUTS = 5


@pytest.fixture(scope="module")
def rows(spark):
    """Partitions of 700, 700 and 3 rows."""
    made = spark.range(0, 1403, 1, 1).select(
        "id", *[F.randn(i).alias(f"c{i}") for i in range(INPUTS)]
    )
    rows = made.select(
        array_to_vector(F.array(*made.columns[1:])).alias("features"),
        (F.col("c0") * F.col("c1") + F.sin("c2") > 0.3).cast("double").alias("label"),
        "id",
    )
    parts = [rows.where(f"id div 700 = {k}") for k in range(3)]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).drop("id").persist()


@pytest.fixture
def chunked(monkeypatch):
    """Every fit goes through chunks."""
    monkeypatch.setattr(network, "FEW_ROWS", 0)


def plain(learner):
    """MLlib's own with the same settings."""
    found = MultilayerPerceptronClassifier(
        labelCol="label", layers=learner.getLayers(), seed=learner.getSeed(),
        blockSize=learner.getBlockSize(), maxIter=learner.getMaxIter(), tol=learner.getTol(),
    )
    weights = learner.getOrDefault("initialWeights") if learner.isSet("initialWeights") else None
    return found if weights is None else found.setInitialWeights(weights)


@pytest.mark.parametrize("size", [1, 100, 128, 5000])
def test_steps_are_mllibs_for_any_block_size(rows, chunked, monkeypatch, size):
    monkeypatch.setattr(network, "_CHUNK", 150)
    monkeypatch.setattr(network, "_NUMBERS", 64)
    learner = ln.network("renewal_pair", INPUTS, label="label", blockSize=size, maxIter=12)
    found, wanted = learner.fit(rows), plain(learner).fit(rows)
    assert np.abs(found.weights.toArray() - wanted.weights.toArray()).max() < 1e-7
    assert found.getLayers() == wanted.getLayers()
    assert found.transform(rows).columns == wanted.transform(rows).columns


@pytest.mark.parametrize("study", ["churn_network_deep", "churn_network_custom"])
def test_a_studys_network_takes_mllibs_steps(rows, chunked, study):
    learner = STUDIES[study].learner(INPUTS, "label", None, 7).setMaxIter(6)
    found, wanted = learner.fit(rows), plain(learner).fit(rows)
    assert np.abs(found.weights.toArray() - wanted.weights.toArray()).max() < 1e-9


def test_group_means_from_uneven_partitions(spark, chunked):
    made = spark.range(0, 5001, 1, 7).selectExpr(
        "id % 2 line", "cast(id % 10 < 3 + 4 * (id % 2) as double) label"
    )
    rows = made.select(
        array_to_vector(F.array(F.expr("1D - line"), F.expr("line + 0D"))).alias("features"),
        "label", "line",
    )
    model = ln.network("none", 2, label="label", blockSize=1, tol=1e-12, maxIter=1000).fit(rows)
    means = {r.line: r.m for r in rows.groupBy("line").agg(F.avg("label").alias("m")).collect()}
    weights = model.weights.toArray().reshape(3, 2)
    for line, mean in means.items():
        a, b = weights[line] + weights[2]
        assert 1 / (1 + np.exp(a - b)) == pytest.approx(mean, abs=1e-6)


def test_the_sigmoid_is_right_to_rounding():
    """Off the grid, on it, half-way between its points, far out, and for no number."""
    points = np.arange(-40 * 1024, 40 * 1024 + 1) / 1024
    x = np.concatenate([np.random.default_rng(1).normal(0, 8, 50_000), points, points + 1 / 2048])
    x = x[np.abs(x) < 40]
    odd = np.array([50.0, -50.0, 1e300, -1e300, np.inf, -np.inf, np.nan])
    z = np.concatenate([x, odd]) * -network._GRID
    with np.errstate(over="ignore"):
        network._sigmoid(z, np.empty_like(z), np.empty_like(z), np.empty(z.shape, np.int64))
        wanted = 1 / (1 + np.exp(-x))
    assert np.abs(z[: len(x)] / wanted - 1).max() < 1e-15
    assert z[len(x) : -1] == pytest.approx([1, 0, 1, 0, 1, 0], abs=1e-17) and np.isnan(z[-1])


def test_rows_go_through_the_layers_together_in_room_that_is_used_again():
    """The sums do not depend on the step, nor on what went through the room before."""
    layers, random = [3, 4, 5, 2], np.random.default_rng(2)
    weights = random.normal(size=4 * 4 + 5 * 5 + 6 * 2)
    chunks = []
    for size, share in ((50, 0.5), (7, 1.0), (50, 0.25)):
        x, y = random.normal(size=(size, 3)), random.integers(0, 2, size)
        batch = network._row(x, y, share, 1)
        chunks.append(tuple(batch.column(i)[0].as_py() for i in range(4)))
    one, all_rows = (network._summed(iter(chunks), layers, weights, n) for n in (1, 64))
    parts = sum(network._summed(iter([c]), layers, weights, 8) for c in chunks)
    assert one == pytest.approx(all_rows, abs=1e-10) and parts == pytest.approx(all_rows, abs=1e-10)
    for k in range(len(weights)):
        ends = []
        for sign in (1, -1):
            near = weights.copy()
            near[k] += sign * 1e-5
            ends.append(network._summed(iter(chunks), layers, near, 8)[0])
        assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(all_rows[k + 1], abs=1e-6)


def test_few_rows_are_left_to_mllib(rows, monkeypatch):
    monkeypatch.setattr(network, "_mean_loss", None)
    learner = ln.network("renewal_small", INPUTS, label="label", maxIter=2)
    assert list(learner.fit(rows).weights) == list(plain(learner).fit(rows).weights)


def test_chunks_are_dealt_evenly_and_keep_every_row(spark, rows, chunked):
    """Thirteen partitions on eight cores would take two rounds; and one has most rows."""
    many = rows.crossJoin(spark.range(20).select("id")).drop("id").coalesce(1).persist()
    many = many.unionAll(rows.limit(100).repartition(12))
    learner = ln.network("none", INPUTS, label="label")
    chunks = learner._chunks(many, n := many.count())
    held = chunks.map(lambda c: len(c[1]) // 4).glom().map(sum).collect()
    cores = spark.sparkContext.defaultParallelism
    assert sum(held) == n and len(held) == cores
    assert max(held) <= n / cores + 4 * 1024


@pytest.mark.parametrize(
    "row", ["(null, 1.0)", "(array(1.0, 2.0), null)", "(array(1.0, 2.0), 2.0)",
            "(array(1.0, 2.0), 0.5)", "(array(1.0), 1.0)"]
)
def test_rows_that_no_network_takes_are_refused(spark, chunked, row):
    values = "(array(0.0, 1.0), 0.0), (array(1.0, 1.0), 1.0), " + row
    made = spark.sql(f"SELECT * FROM VALUES {values} AS t(x, label)").selectExpr(
        "cast(x as array<double>) x", "cast(label as double) label"
    )
    rows = made.select(array_to_vector("x").alias("features"), "label")
    for learner in (ln.network("none", 2, label="label"), plain(ln.network("none", 2, label="label"))):
        with pytest.raises(Exception):
            learner.fit(rows)


@pytest.mark.parametrize("bad", ["nan", "inf"])
def test_features_that_are_no_numbers_are_refused(spark, chunked, bad):
    made = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (float(bad), 1.0)], "x double, label double")
    rows = made.select(array_to_vector(F.array("x")).alias("features"), "label")
    for learner in (ln.network("none", 1, label="label"), plain(ln.network("none", 1, label="label"))):
        with pytest.raises(Exception):
            learner.fit(rows)
