"""Classifiers with the studies' settings, and the pipelines around them.

Training reads one table of narrow feature rows, several times over; persist it first (see
``keep_in_memory``). Every learner is seeded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)

from pyspark.sql import DataFrame

from keepsake.constants import (
    FOREST_BINS,
    FOREST_DEPTH,
    FOREST_TREES,
    NETWORK_HIDDEN,
    SHARE_FIFTH,
)
from keepsake.operators.calibrate import PlattScaling
from keepsake.operators.features import (
    assemble,
    detect_categories,
    label_index,
    label_text,
    standardize,
)
from keepsake.operators.missing import flags_to_numbers, mean_imputer, zero_filler
from keepsake.operators.network import BlockNetwork
from keepsake.operators.split import split

DEFAULT_SEED = 7


def forest(
    study: str,
    label: str = "label_index",
    features: str = "features",
    weight: str | None = None,
    seed: int = DEFAULT_SEED,
    **settings,
) -> RandomForestClassifier:
    """Random forest: gini, depth 10, 30 bins; 15 trees for churn, 5 for renewal.

    ``weight`` names a row weight column, which makes the forest class-balanced. ``settings``
    overrides any of MLlib's parameters by name.
    """
    learner = RandomForestClassifier(
        labelCol=label,
        featuresCol=features,
        impurity="gini",
        maxDepth=FOREST_DEPTH,
        maxBins=FOREST_BINS,
        numTrees=FOREST_TREES[study],
        seed=seed,
    ).setParams(**settings)
    return learner.setWeightCol(weight) if weight else learner


def logistic(
    penalty: str | None = None,
    strength: float = 0.01,
    label: str = "label_index",
    features: str = "features",
    weight: str | None = None,
    **settings,
) -> LogisticRegression:
    """Linear classifier: plain, or with an ``'l1'`` or ``'l2'`` penalty.

    ``strength`` is MLlib's; `penalty_strength` gives it for an inverse strength C. ``settings``
    overrides MLlib's parameters by name, such as ``maxIter`` and ``tol``; whether a fit converged
    is in the model's ``summary.totalIterations``.
    """
    mixing = {None: 0.0, "l1": 1.0, "l2": 0.0}[penalty]
    learner = LogisticRegression(
        labelCol=label,
        featuresCol=features,
        regParam=strength if penalty else 0.0,
        elasticNetParam=mixing,
    ).setParams(**settings)
    return learner.setWeightCol(weight) if weight else learner


def penalty_strength(train: DataFrame, inverse: float = 1.0) -> float:
    """MLlib's ``strength`` for an inverse strength C, which weighs the summed loss of the training
    rows against the penalty: 1 / (rows * C). One count; an error without rows."""
    rows = train.count()
    if not rows or inverse <= 0:
        raise ValueError("an inverse strength is over 0, for one row or more")
    return 1 / (rows * inverse)


def linear_svc(
    label: str = "label_index", features: str = "features", **settings
) -> LinearSVC:
    """Support-vector classifier with a linear kernel. It gives a margin; `calibrated_svc` adds a
    probability.

    The solver stops as MLlib's does by default; ``settings`` (``maxIter``, ``tol``, ``regParam``)
    overrides that.
    """
    return LinearSVC(labelCol=label, featuresCol=features, regParam=0.01).setParams(**settings)


def calibrated_svc(
    train: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    label: str = "label",
    scaling: str | None = "standard",
    held: float = SHARE_FIFTH,
    seed: int = DEFAULT_SEED,
    **settings,
) -> PipelineModel:
    """A fitted support-vector pipeline that gives probabilities.

    The share ``held`` of the training rows, by a hash of ``key``, is kept from the classifier, and
    its margins are scaled to probabilities by Platt's method (`PlattScaling`). ``prediction``
    stays the side of the margin. The result is one pipeline that can be saved.
    """
    fitted, rest = split(train, key, held, seed + 1)
    stages = classification_stages(linear_svc(label, **settings), columns, scaling=scaling)
    model = stages.fit(fitted)
    scale = PlattScaling(labelCol=label).fit(model.transform(rest))
    return PipelineModel([*model.stages, scale])


def network(
    shape: str,
    inputs: int,
    classes: int = 2,
    label: str = "label_index",
    features: str = "features",
    seed: int = DEFAULT_SEED,
    **settings,
) -> BlockNetwork:
    """Feed-forward network with the named hidden layers; ``'none'`` has none.

    Layer shape and task are the study's; the training is MLlib's: sigmoid hidden units, softmax
    output, L-BFGS over the whole training set. ``settings`` overrides its parameters by name.
    MLlib weighs each block of ``blockSize`` rows alike, a partition's last and shorter one too;
    ``blockSize=1`` gives the optimum over the rows. `BlockNetwork` makes the passes.
    """
    return BlockNetwork(
        labelCol=label,
        featuresCol=features,
        layers=[inputs, *({**NETWORK_HIDDEN, "none": ()}[shape]), classes],
        seed=seed,
    ).setParams(**settings)


def classification_stages(
    learner: Estimator,
    columns: Sequence[str],
    labels: Sequence[str] | None = None,
    label: str = "label",
    scaling: str | None = None,
    categories: bool = False,
    impute: bool = False,
    zeros: bool = False,
    flags: Sequence[str] = (),
) -> Pipeline:
    """Everything from typed columns to a decoded prediction, as one pipeline.

    With ``labels`` (negative, positive) the label is text: it is indexed as ``label_index`` and
    the prediction is decoded as ``predicted_label``. Without, the label is a number already.
    ``scaling`` is None, ``'standard'`` or ``'center'``; ``categories`` re-indexes features with
    few values; ``impute`` fills missing numbers with training means, and the ``flags`` among the
    columns with their share of true; ``zeros`` fills both with 0.0 instead.
    """
    if scaling and categories:
        raise ValueError("scaled features have no categories; choose one of the two")
    before = [label_index(label, labels, "label_index")] if labels else []
    after = [label_text("prediction", labels, "predicted_label")] if labels else []
    if impute and zeros:
        raise ValueError("missing cells are filled with means or with zeros; choose one of the two")
    if impute:
        before.extend([flags_to_numbers(flags)] if flags else [])
        before.append(mean_imputer(columns))
    if zeros:
        before.append(zero_filler(columns))
    if scaling:
        shaped = [standardize("raw_features", "features", scale=scaling == "standard")]
    elif categories:
        shaped = [detect_categories("raw_features", "features")]
    else:
        shaped = []
    vector = assemble(columns, "raw_features" if shaped else "features")
    return Pipeline(stages=[*before, vector, *shaped, learner, *after])
