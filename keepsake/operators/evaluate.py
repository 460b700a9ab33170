"""Scored tables to metrics, as DataFrames.

Everything starts from counts that are combined before they are shuffled. The curve areas order
the distinct scores in ranges, one window per range, and join the ranges by their totals, so no
task ever sees all scores. Ties are exact: rows with equal scores are one point of the curve.

Each call reads the scored table, the curve areas twice; persist or write it first if scoring is
costly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from keepsake.functions.cells import column, without_nan
from keepsake.functions.scores import element

_MAX_RANGES = 10_000
_SKETCH_GROUPS = 64


def listing(
    scored: DataFrame,
    key: Sequence[str],
    label: str = "label",
    prediction: str = "prediction",
    probability: str | None = None,
) -> DataFrame:
    """``key, label, prediction`` (and the positive-class probability) per row, distributed."""
    taken = {"label", "prediction", "probability"} & set(key)
    if taken:
        raise ValueError(f"the listing has its own {sorted(taken)}; choose other key columns")
    chosen = [*[column(c) for c in key], column(label).alias("label"),
              column(prediction).alias("prediction")]
    if probability:
        chosen.append(element(column(probability), 1).alias("probability"))
    return scored.select(*chosen)


def confusion(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``(label, prediction, n)``."""
    return scored.groupBy(
        column(label).alias("label"), column(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_report(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``(class, precision, recall, f1, support)`` per class and an ``avg / total`` row.

    The last row weights by support. A 0/0 counts as 0.0. A row without a label or a prediction is
    an error.
    """
    cells = confusion(scored, label, prediction)
    refused = F.raise_error(F.lit("rows without a label or a prediction")).cast("long")
    known = F.col("label").isNotNull() & F.col("prediction").isNotNull()
    cells = cells.withColumn("n", F.when(known, F.col("n")).otherwise(refused))
    none = F.lit(0).cast("long")
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(none)

    def side(name: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(name).cast("string").alias("class"),
            support.alias("support"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    both = F.array(
        side("label", F.col("n"), none, right), side("prediction", none, F.col("n"), none)
    )
    sides = cells.select(F.inline(both))
    sums = sides.groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]
    )
    per_class = sums.select(
        "class",
        _ratio("hits", "predicted").alias("precision"),
        _ratio("hits", "support").alias("recall"),
        _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )
    is_class = F.grouping("class") == 0
    measures = [
        F.when(is_class, F.max(m))
        .otherwise(F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")))
        .alias(m)
        for m in ("precision", "recall", "f1")
    ]
    return per_class.rollup("class").agg(
        F.when(is_class, F.col("class")).otherwise(F.lit("avg / total")).alias("name"),
        *measures,
        F.sum("support").alias("support"),
    ).select(F.col("name").alias("class"), "precision", "recall", "f1", "support")


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label. A row without either is an error."""
    return scored.agg(_hit_share(column(prediction), column(label)).alias("accuracy"))


def accuracy_percent(scored: DataFrame, predicted_class: Column, actual_class: Column) -> DataFrame:
    """Percentage of rows whose predicted class is the actual class. A row without either is an
    error."""
    share = _hit_share(predicted_class, actual_class)
    return scored.agg((F.lit(100.0) * share).alias("accuracy_percent"))


def _hit_share(predicted: Column, actual: Column) -> Column:
    hit = predicted == actual
    refused = F.raise_error(F.lit("rows without a label or a prediction")).cast("double")
    return F.when(F.count_if(hit.isNull()) == 0, F.avg(hit.cast("double"))).otherwise(refused)


def balanced_accuracy(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Mean of both classes' recall: the area under the ROC curve of hard 0/1 predictions.

    NULL if a class is absent.
    """
    return evaluate(scored, ("balanced_accuracy",), label, prediction).select(
        F.col("value").alias("balanced_accuracy")
    )


def area_under_roc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve of the scores; NULL if a class is absent."""
    return evaluate(scored, ("area_under_roc",), label, score=score).select(
        F.col("value").alias("area_under_roc")
    )


def area_under_pr(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the precision-recall curve, by trapezoids over every distinct score."""
    return evaluate(scored, ("area_under_pr",), label, score=score).select(
        F.col("value").alias("area_under_pr")
    )


METRICS = ("accuracy", "balanced_accuracy", "area_under_roc", "area_under_pr")


def evaluate(
    scored: DataFrame,
    metrics: Sequence[str] = METRICS,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
) -> DataFrame:
    """``(metric, value)`` for the chosen metrics.

    ``label`` and ``prediction`` hold 0 or 1; a higher ``score`` means class 1 is more likely.
    Metrics of hard predictions take one aggregation. The curve areas take that same pass, run at
    once to learn how the scores are spread, and a second one over the distinct scores. A label
    that is neither 0 nor 1, or a row without a score, is an error: no row is left out.
    """
    unknown = set(metrics) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}; known are {METRICS}")
    areas = [m for m in metrics if m.startswith("area")]

    positive, negative = column(label) == 1, column(label) == 0
    counts = {
        "n_rows": F.count(F.lit(1)),
        "pos": F.count_if(positive),
        "neg": F.count_if(negative),
    }
    if len(areas) < len(metrics):
        counts["hit_pos"] = F.count_if(positive & (column(prediction) == 1))
        counts["hit_neg"] = F.count_if(negative & (column(prediction) == 0))
        counts["predicted"] = F.count(column(prediction))
    if areas:
        number = without_nan(column(score).cast("double"))
        counts["n_scored"] = F.count(number)
        found = _count_and_cut(scored, counts, number)
        if found.n_scored < found.n_rows:
            raise ValueError(f"{found.n_rows - found.n_scored} rows have no {score}")
        points = _points(scored, number, positive, negative, found.cuts or [])
        counted = _area_sums(points).select(
            "roc", "pr", *[F.lit(found[c]).alias(c) for c in counts]
        )
    else:
        counted = scored.agg(*[value.alias(name) for name, value in counts.items()])

    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    values = {
        "accuracy": lambda: F.try_divide(F.col("hit_pos") + F.col("hit_neg"), "n_rows"),
        "balanced_accuracy": lambda: (
            F.try_divide("hit_pos", pos) + F.try_divide("hit_neg", neg)
        ) / 2,
        "area_under_roc": lambda: F.try_divide("roc", pos * neg),
        "area_under_pr": lambda: F.try_divide("pr", pos),
    }
    refused = F.raise_error(F.lit(f"{label} holds values other than 0 and 1"))
    if "predicted" in counts:
        blank = F.raise_error(F.lit(f"rows without a {prediction}")).cast("double")
        for m in ("accuracy", "balanced_accuracy"):
            values[m] = lambda value=values[m]: F.when(
                F.col("predicted") == F.col("n_rows"), value()
            ).otherwise(blank)
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.when(F.col("pos") + F.col("neg") == F.col("n_rows"), values[m]())
            .otherwise(refused.cast("double"))
            .alias("value"),
        )
        for m in metrics
    ]
    return counted.select(F.inline(F.array(*rows)))


def _count_and_cut(scored: DataFrame, counts: dict[str, Column], score: Column) -> Row:
    """The counts of all rows, and ``cuts``: scores that part the rows about evenly.

    Quantiles of groups of input partitions first, then quantiles of those, so that no task has
    to merge the sketches of every other task.
    """
    ranges = min(int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")), _MAX_RANGES)
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    by_group = (
        scored.withColumn("_group", F.spark_partition_id() % _SKETCH_GROUPS)
        .groupBy("_group")
        .agg(
            *[value.alias(name) for name, value in counts.items()],
            F.percentile_approx(score, shares, 2 * ranges).alias("cuts"),
        )
    )
    sums = by_group.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        F.flatten(F.collect_list("cuts")).alias("cuts"),
    )
    # At most _SKETCH_GROUPS lists were collected, each as long as ``shares``.
    found = sums.withColumn("cuts", F.array_sort("cuts")).withColumn(
        "cuts",
        F.transform(
            F.sequence(F.lit(1), F.lit(len(shares))),
            lambda i: F.get("cuts", (i * F.size("cuts") / (len(shares) + 1)).cast("int")),
        ),
    )
    return found.first()


def _points(
    scored: DataFrame, score: Column, positive: Column, negative: Column, cuts: Sequence[float]
) -> DataFrame:
    """``(range, score, pos, neg)``: the distinct scores, counted, and numbered by score range.

    Any cuts give the same areas. Quantiles only keep the ranges, and so the windows over them,
    about equally small.
    """
    finite = sorted({c for c in cuts if c is not None and abs(c) != float("inf")})
    labelled = scored.select(score.alias("score"), positive.alias("p"), negative.alias("n"))
    if finite:
        splits = [-float("inf"), *finite, float("inf")]
        labelled = Bucketizer(splits=splits, inputCol="score", outputCol="place").transform(
            labelled
        )
    else:
        labelled = labelled.withColumn("place", F.lit(0))
    place = F.coalesce(F.col("place").cast("int"), F.lit(0)).alias("range")
    return labelled.groupBy(place, "score").agg(
        F.count_if("p").alias("pos"), F.count_if("n").alias("neg")
    )


def _area_sums(points: DataFrame) -> DataFrame:
    """The sums behind both curve areas, ``(roc, pr)``.

    Running counts are windows inside each range. What lies in the higher ranges comes from the
    range totals, a table of at most _MAX_RANGES rows, which is why it may be broadcast.
    """
    totals = points.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    higher_ranges = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    above = totals.select(
        "range",
        F.coalesce(F.sum("p").over(higher_ranges), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("n").over(higher_ranges), F.lit(0)).alias("neg_above"),
    )
    down_to_here = (
        Window.partitionBy("range")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = points.withColumns(
        {"run_pos": F.sum("pos").over(down_to_here), "run_neg": F.sum("neg").over(down_to_here)}
    ).join(F.broadcast(above), "range")

    true_pos = (F.col("pos_above") + F.col("run_pos")).cast("double")
    false_pos = (F.col("neg_above") + F.col("run_neg")).cast("double")
    true_before, false_before = true_pos - F.col("pos"), false_pos - F.col("neg")
    precision = true_pos / (true_pos + false_pos)
    # The curve starts at recall 0 with the precision of its first point.
    precision_before = F.coalesce(F.try_divide(true_before, true_before + false_before), precision)
    # Always true. With it either area needs both counts, so the totals and the points are one table
    # that is made once, also when a single area is asked for.
    counted = true_pos + false_pos > 0
    return running.agg(
        F.sum(F.when(counted, F.col("neg") * (true_pos + true_before) / 2)).alias("roc"),
        F.sum(F.col("pos") * (precision + precision_before) / 2).alias("pr"),
    )


def _ratio(top: Column | str, bottom: Column | str) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))
