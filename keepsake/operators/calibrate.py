"""Probabilities for classifiers that only give a margin.

Platt scaling: p = 1 / (1 + exp(-(slope * margin + offset))), fitted by maximum likelihood to rows
that the classifier was not fitted on. The two numbers are found by Newton steps, whose gradient and
curvature are five sums over the rows; nothing but these sums leaves the tasks.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.functions.cells import column

STEPS = 100
TOLERANCE = 1e-10


def margin(raw_prediction: str) -> Column:
    """The raw prediction's second element: positive on the positive side."""
    return vector_to_array(column(raw_prediction))[1]


def fit_sigmoid(
    df: DataFrame, margin_column: str, label: str, steps: int = STEPS, tolerance: float = TOLERANCE
) -> tuple[float, float]:
    """(slope, offset) for a table of margins and 0/1 labels.

    Targets are (n1 + 1) / (n1 + 2) for positive rows and 1 / (n0 + 2) for negative ones instead of 1
    and 0, so separable margins have a finite optimum. A step is two aggregates: the sums for its
    direction, and the losses of its halvings, all in one pass. The last step is the first whose
    direction promises less than `tolerance` a row. Rows with a NULL margin or label, or another label, are an error; so
    is a table without rows. Equal margins of one class give slope 0 or close to it.
    """
    rows = df.select(
        column(margin_column).cast("double").alias("x"), column(label).cast("double").alias("y")
    )
    fine = F.col("x").isNotNull() & ~F.isnan("x") & F.col("y").isin(0.0, 1.0)
    n, n_fine, n1 = rows.agg(
        F.count(F.lit(1)), F.count_if(fine), F.count_if(fine & (F.col("y") == 1))
    ).first()
    if not n:
        raise ValueError("no rows to calibrate on")
    if n_fine < n:
        raise ValueError(f"{n - n_fine} rows without a margin or a 0/1 label")
    high, low = (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2)
    # Equal margins are one row with its two counts: a frequent margin is summed once.
    target = F.when(F.col("y") == 1, high).otherwise(low)
    points = rows.select("x", target.alias("t"))

    slope, offset = 0.0, math.log((n1 + 1) / (n - n1 + 1))
    now = points.agg(_loss(slope, offset)).first()[0]
    for _ in range(steps):
        p = _sigmoid(F.lit(slope) * F.col("x") + offset)
        e, w, x = p - F.col("t"), p * (1 - p), F.col("x")
        ga, gb, haa, hab, hbb = points.agg(
            F.sum(e * x), F.sum(e), F.sum(w * x * x), F.sum(w * x), F.sum(w)
        ).first()
        haa, hbb = haa + 1e-12, hbb + 1e-12
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = -(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det
        promised = -(ga * da + gb * db)
        sizes = [2.0**-k for k in range(12)]
        tried = points.agg(*[_loss(slope + s * da, offset + s * db) for s in sizes]).first()
        fit = [s for s, loss in zip(sizes, tried) if loss <= now - 1e-4 * s * promised]
        if not fit:
            break
        now = tried[sizes.index(fit[0])]
        slope, offset = slope + fit[0] * da, offset + fit[0] * db
        if promised <= tolerance * n:
            break
    return slope, offset


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def _loss(slope: float, offset: float) -> Column:
    """Cross-entropy, written so that no exponential overflows."""
    z = F.lit(slope) * F.col("x") + offset
    return F.sum(F.greatest(z, F.lit(0.0)) - z * F.col("t") + F.log1p(F.exp(-F.abs(z))))


class PlattScaling(
    Estimator, HasLabelCol, HasRawPredictionCol, HasProbabilityCol,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Fits the sigmoid to a classifier's raw predictions. Fit it on rows held out from that
    classifier; the model adds a probability vector and is saved like any other stage."""

    @keyword_only
    def __init__(
        self, *, labelCol="label", rawPredictionCol="rawPrediction", probabilityCol="probability"
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PlattModel:
        marked = dataset.select(
            margin(self.getRawPredictionCol()).alias("margin"),
            column(self.getLabelCol()).alias("label"),
        )
        slope, offset = fit_sigmoid(marked, "margin", "label")
        return PlattModel(
            rawPredictionCol=self.getRawPredictionCol(), probabilityCol=self.getProbabilityCol(),
            slope=slope, offset=offset,
        )


class PlattModel(
    Model, HasRawPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable
):
    slope = Param(Params._dummy(), "slope", "factor of the margin", TypeConverters.toFloat)
    offset = Param(Params._dummy(), "offset", "added to it", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, rawPredictionCol="rawPrediction", probabilityCol="probability",
                 slope=1.0, offset=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        slope, offset = self.getOrDefault(self.slope), self.getOrDefault(self.offset)
        chance = _sigmoid(F.lit(slope) * margin(self.getRawPredictionCol()) + offset)
        vector = array_to_vector(F.array(1 - chance, chance))
        return dataset.withColumn(self.getProbabilityCol(), vector)
