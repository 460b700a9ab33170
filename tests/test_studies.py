"""The studies on files: fitted on training rows only, positive class fixed, missing columns."""

import json
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from keepsake import constants as C
from keepsake.__main__ import main
from keepsake.operators import evaluate as ev
from keepsake.operators import split as sp
from keepsake.plans import derived, studies
from keepsake.sources import schemas


@pytest.fixture(scope="module")
def renewal_csv(spark, sf_dir):
    return derived.write_renewal_csv(spark, sf_dir)


@pytest.fixture(scope="module")
def churn_lines(spark, sf_dir):
    return derived.write_churn_lines(spark, sf_dir)


def test_split_is_disjoint_and_complete(spark, churn_lines):
    result = studies.run_study(spark, "churn_forest", churn_lines, key=["phone"])
    table = schemas.read_churn(spark, churn_lines)
    assert result.train.count() + result.test.count() == table.count()
    assert result.scored.count() == result.test.count()
    test = {r.phone for r in result.test.collect()}
    assert test == {r.phone for r in table.where(sp.held_out(["phone"], 0.2)).collect()}
    listed = result.listing(["phone"])
    assert listed.columns == ["phone", "label", "prediction", "probability"]
    assert listed.count() == len(test)
    result.release()


def test_positive_class_stays_positive_when_it_is_the_larger(spark, churn_lines, tmp_path):
    """With the label texts exchanged, the very same rows are positive, and now they are many."""
    flipped = str(tmp_path / "flipped")
    lines = spark.read.text(churn_lines)
    swapped = F.when(F.col("value").endswith("True."), F.regexp_replace("value", r"True\.$", "False."))
    lines.select(
        swapped.otherwise(F.regexp_replace("value", r"False\.$", "True.")).alias("value")
    ).write.text(flipped)
    for path in (churn_lines, flipped):
        result = studies.run_study(spark, "churn_forest", path, key=["phone"])
        wrong = result.scored.where((F.col("label") == "True.") != (F.col("label_index") == 1.0))
        assert wrong.count() == 0
        decoded = result.scored.where(
            (F.col("predicted_label") == "True.") != (F.col("prediction") == 1.0)
        )
        assert decoded.count() == 0
        result.release()


@pytest.mark.parametrize("study", ["churn_linear", "churn_forest_exact"])
def test_a_study_reads_each_row_once(spark, study):
    """Typing text cells costs more than any other pass over the table."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def typed(cell):
        read.add(1)
        return float(cell)

    rows = spark.range(0, 300, 1, 3).select(
        typed(F.concat(F.col("id") % 50, F.lit(".5"))).alias("x"),
        F.randn(3).alias("y"), (F.col("id") % 2).cast("double").alias("label"),
    )
    result = studies.fit_and_score(studies.STUDIES[study], rows)
    assert result.train.count() + result.test.count() == 300
    assert result.metrics().count() > 0
    assert read.value == 300
    kept = (result.table, result.train, result.test)
    assert all(t.storageLevel.useMemory for t in kept)
    result.release()
    assert not any(t.storageLevel.useMemory for t in kept)


@pytest.mark.parametrize("study", ["churn_linear", "churn_forest"])
def test_a_study_hashes_a_row_once(spark, monkeypatch, study):
    """Passes of the split and its parts read the hashes, whatever the table's columns are called."""
    labels = studies.STUDIES[study].labels or (0.0, 1.0)
    rows = spark.range(0, 300, 1, 3).select(
        (F.col("id") % 50).cast("double").alias("Key_Hash"), F.randn(3).alias("_key_hash"),
        F.when(F.col("id") % 2 == 0, F.lit(labels[0])).otherwise(F.lit(labels[1])).alias("label"),
    )
    wanted = studies.fit_and_score(studies.STUDIES[study], rows)
    held = sorted(wanted.test.collect())
    wanted.release()
    monkeypatch.setattr(sp, "key_hash", lambda *_: F.raise_error(F.lit("made again")))
    result = studies.fit_and_score(studies.STUDIES[study], rows)
    assert result.train.columns == result.test.columns == rows.columns
    assert sorted(result.test.collect()) == held and 0 < len(held) < 300
    assert result.train.count() == 300 - len(held)
    result.release()


def test_metrics_and_report_score_a_row_once(spark):
    scored = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def model(chance):
        scored.add(1)
        return [1 - chance, chance]

    rows = spark.range(0, 200, 1, 3).select(
        (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 7 / 7).alias("x")
    )
    marked = rows.select(
        "label", array_to_vector(model("x")).alias("probability"),
        (F.col("x") > 0.5).cast("double").alias("prediction"),
    )
    result = studies.Result(None, rows, rows, marked, "label")
    assert {r.metric for r in result.metrics().collect()} == set(ev.METRICS)
    assert result.report().count() == 3
    assert scored.value == 200
    kept = result.marks
    assert kept.storageLevel.useMemory
    result.release()
    assert not kept.storageLevel.useMemory


def test_means_and_scales_come_from_training_rows(spark, renewal_csv):
    result = studies.run_study(spark, "renewal_network_small", renewal_csv)
    imputer, _, scaler = result.model.stages[:3]
    means = result.train.agg(*[F.avg(c).alias(c) for c in C.RENEWAL_FEATURES]).first()
    for c in C.RENEWAL_FEATURES:
        assert imputer.surrogateDF.first()[c] == pytest.approx(means[c])
    filled = imputer.transform(result.train).agg(
        *[F.avg(c).alias(c) for c in C.RENEWAL_FEATURES]
    ).first()
    assert list(scaler.stages[0].mean) == pytest.approx(list(filled))
    result.release()


@pytest.mark.parametrize("fill", ["mean", "zero"])
def test_churn_lines_with_unreadable_cells(spark, churn_lines, tmp_path, fill):
    """Every fifth account has an unreadable number and an unknown flag."""
    path = str(tmp_path / "odd")
    cells = F.split("value", ",")
    odd = F.array_join(
        F.transform(cells, lambda c, i: F.when(i == 4, "n/a").when(i == 7, "?").otherwise(c)), ","
    )
    hit = F.pmod(F.hash(F.get(cells, 3)), F.lit(5)) == 0
    lines = spark.read.text(churn_lines)
    lines.select(F.when(hit, odd).otherwise(F.col("value")).alias("value")).write.text(path)
    n_odd = lines.where(hit).count()
    result = studies.run_study(spark, "churn_forest", path, key=["phone"], fill=fill)
    missing = {r.column: r.n_missing for r in result.missing().collect() if r.n_missing}
    assert missing == {"int_plan": n_odd, "day_mins": n_odd} and n_odd > 0
    assert result.scored.count() == result.test.count()
    assert all(r.value is not None for r in result.metrics().collect())
    model = str(tmp_path / "model")
    result.model.save(model)
    again = PipelineModel.load(model).transform(result.test)
    assert again.select("phone", "prediction").exceptAll(
        result.scored.select("phone", "prediction")
    ).isEmpty()
    filled = result.model.stages[1 if fill == "zero" else 2].transform(
        result.test if fill == "zero" else result.model.stages[1].transform(result.test)
    )
    flag = result.train.agg(F.avg(F.col("int_plan").cast("double"))).first()[0]
    odd_rows = filled.join(result.test.where("int_plan is null").select("phone"), "phone")
    expected = 0.0 if fill == "zero" else flag
    assert [r.int_plan for r in odd_rows.collect()] == pytest.approx([expected] * odd_rows.count())
    result.release()


def test_fill_is_a_known_word(spark, churn_lines):
    with pytest.raises(ValueError, match="fill"):
        studies.run_study(spark, "churn_forest", churn_lines, fill="median")


def test_feature_without_values_is_dropped_and_named(spark, renewal_csv, tmp_path):
    path = str(tmp_path / "gap")
    table = spark.read.csv(renewal_csv, header=True)
    table.withColumn("Email_Open_R", F.lit("")).write.csv(path, header=True)
    result = studies.run_study(spark, "renewal_forest_balanced", path)
    assert result.dropped == ("Email_Open_R",)
    assert result.metrics(("accuracy",)).first().value > 0.5
    result.release()


def test_balanced_study_weights_classes_evenly(spark, renewal_csv):
    from keepsake.operators.profile import with_class_weight

    result = studies.run_study(spark, "renewal_forest_balanced", renewal_csv)
    weighted = with_class_weight(result.train, result.train, "label")
    sums = [r.w for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()]
    assert len(sums) == 2 and sums[0] == pytest.approx(sums[1])
    result.release()


def test_correlation_listing_includes_the_target(spark, renewal_csv):
    top = studies.renewal_correlations(spark, renewal_csv).collect()
    assert len(top) == 10
    assert top[0].feature == C.RENEWAL_HEADER_CODE and top[0].r == pytest.approx(1.0)


def test_command_line(spark, churn_lines, tmp_path):
    out = str(tmp_path / "out")
    main(["churn_forest", churn_lines, out, "--key", "phone"])
    metrics = {r.metric: r.value for r in spark.read.parquet(out + "/metrics").collect()}
    assert metrics["area_under_roc"] > 0.6
    classes = {r["class"] for r in spark.read.parquet(out + "/report").collect()}
    assert classes == {"0.0", "1.0", "avg / total"}
    listing = spark.read.parquet(out + "/listing")
    held_out = spark.read.csv(out + "/held_out", header=True)
    assert held_out.columns[0] == "phone" and held_out.count() == listing.count()
    assert {r.n_missing for r in spark.read.parquet(out + "/missing").collect()} == {0}
    model = PipelineModel.load(out + "/model")
    again = model.transform(schemas.read_churn(spark, churn_lines)).select("phone", "prediction")
    joined = listing.join(again.withColumnRenamed("prediction", "again"), "phone")
    assert joined.count() == listing.count() > 0
    assert joined.where("prediction <> again").count() == 0


def test_bench_prints_one_line(sf_dir):
    done = subprocess.run(
        [sys.executable, "bench.py", "accuracy"], capture_output=True, text=True, timeout=300,
        env={**__import__("os").environ, "BENCH_SF_DIR": sf_dir, "BENCH_CPUS": "2"},
    )
    found = json.loads(done.stdout)
    assert set(found) == {"metric", "value", "unit", "queries", "sf"}
    assert found["queries"]["accuracy"] > 0
