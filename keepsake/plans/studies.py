"""The studies, end to end: read, clean, split, fit on train, score test, evaluate.

The forests and the four networks named deep, wide, small and pair are the main ones. The linear
models and the custom network are alternatives on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from keepsake import constants as C
from keepsake.functions.keys import key_hash
from keepsake.functions.labels import equals_label
from keepsake.functions.scores import element
from keepsake.operators import columns as cols
from keepsake.operators import evaluate as ev
from keepsake.operators.learners import classification_stages, forest, logistic, network
from keepsake.operators.missing import columns_without_values, null_audit
from keepsake.operators.profile import top_correlations, with_class_weight
from keepsake.operators.split import DEFAULT_SEED, split, split_exact
from keepsake.sources import schemas
from keepsake.sources.sinks import keep_in_memory

FILLS = ("error", "mean", "zero")


@dataclass(frozen=True)
class Study:
    """One study's choices. ``labels`` is set where the label column holds text. ``impute`` makes
    training means, not an error, its usual answer to a missing cell."""

    read: Callable[[SparkSession, str], DataFrame]
    learner: Callable[[int, str, str | None, int], Estimator]  # inputs, label, weight, seed
    share: float
    exact: bool
    labels: tuple[str, str] | None = None
    excluded: tuple[str, ...] = ("label",)
    scaling: str | None = None
    categories: bool = False
    impute: bool = False
    balanced: bool = False


@dataclass(frozen=True)
class Result:
    """A fitted model, its training and test rows, the scored test rows, and the table as read, with
    the hashes of its keys."""

    model: PipelineModel
    train: DataFrame
    test: DataFrame
    scored: DataFrame
    label: str
    dropped: tuple[str, ...] = ()  # features without a single value in train
    table: DataFrame | None = None

    def release(self) -> None:
        """Drop the cached table, splits and scores once the results are written."""
        for rows in (self.train, self.test, self.table, self.__dict__.get("marks")):
            if rows is not None:
                rows.unpersist()

    @cached_property
    def marks(self) -> DataFrame:
        """Label, prediction and score of the test rows, which the metrics read several times: kept
        in memory, so that the model scores a row once."""
        chosen = [self.label, "prediction", "score"]
        return keep_in_memory(cols.keep(self.with_score(), chosen))[0]

    def with_score(self) -> DataFrame:
        return self.scored.withColumn("score", element(F.col("probability"), 1))

    def metrics(self, metrics: Sequence[str] = ev.METRICS) -> DataFrame:
        return ev.evaluate(self.marks, metrics, self.label)

    def missing(self) -> DataFrame:
        """``(column, n_rows, n_missing)`` of the features: the cells that were filled."""
        features = [c for c in self.train.columns if c != "label"]
        return null_audit(cols.keep(self.train, features).unionAll(cols.keep(self.test, features)))

    def report(self) -> DataFrame:
        return ev.classification_report(self.marks, self.label)

    def listing(self, key: Sequence[str]) -> DataFrame:
        return ev.listing(self.scored, key, self.label, probability="probability")


def _forest(study: str):
    return lambda inputs, label, weight, seed: forest(study, label, weight=weight, seed=seed)


def _network(shape: str):
    return lambda inputs, label, weight, seed: network(shape, inputs, label=label, seed=seed)


def _logistic(penalty: str | None = None):
    return lambda inputs, label, weight, seed: logistic(penalty, label=label, weight=weight)


def _renewal_filled_with_zero(spark: SparkSession, path: str) -> DataFrame:
    return schemas.read_renewal(spark, path, fill="zero")


def _renewal_by_text(spark: SparkSession, path: str) -> DataFrame:
    raw = schemas.read_renewal_with_header(spark, path)
    label = equals_label(F.col(C.RENEWAL_HEADER_LABEL), C.RENEWAL_LABELS[1])
    return raw.withColumn("label", label).drop(C.RENEWAL_HEADER_LABEL)


def _renewal_by_code(spark: SparkSession, path: str) -> DataFrame:
    raw = schemas.read_renewal_with_header(spark, path, C.RENEWAL_HEADER_CODE)
    label = equals_label(F.col(C.RENEWAL_HEADER_CODE), C.RENEWAL_POSITIVE_CODE)
    return raw.withColumn("label", label).drop(C.RENEWAL_HEADER_CODE)


STUDIES: dict[str, Study] = {
    "churn_forest": Study(
        schemas.read_churn, _forest("churn"), C.SHARE_FIFTH, exact=False,
        labels=C.CHURN_LABELS, excluded=C.CHURN_EXCLUDED, categories=True,
    ),
    "churn_forest_exact": Study(
        schemas.read_churn_with_header, _forest("churn"), C.SHARE_QUARTER, exact=True,
    ),
    "churn_network_deep": Study(
        schemas.read_churn_with_header, _network("churn_deep"), C.SHARE_FIFTH, exact=True,
        scaling="standard",
    ),
    "churn_network_wide": Study(
        schemas.read_churn_with_header, _network("churn_wide"), C.SHARE_FIFTH, exact=True,
        scaling="standard",
    ),
    "renewal_forest": Study(
        _renewal_filled_with_zero, _forest("renewal"), C.SHARE_FIFTH, exact=False,
        labels=C.RENEWAL_LABELS, scaling="center",
    ),
    "renewal_forest_balanced": Study(
        _renewal_by_code, _forest("renewal"), C.SHARE_THREE_TENTHS, exact=True,
        impute=True, balanced=True,
    ),
    "renewal_network_small": Study(
        _renewal_by_text, _network("renewal_small"), C.SHARE_FIFTH, exact=True,
        impute=True, scaling="standard",
    ),
    "renewal_network_pair": Study(
        _renewal_by_text, _network("renewal_pair"), C.SHARE_THREE_TENTHS, exact=True,
        impute=True, scaling="standard",
    ),
    "churn_linear": Study(
        schemas.read_churn_with_header, _logistic(), C.SHARE_FIFTH, exact=True,
        scaling="standard",
    ),
    "churn_network_custom": Study(
        schemas.read_churn_with_header, _network("churn_custom"), C.SHARE_FIFTH, exact=True,
        scaling="standard",
    ),
    "churn_logistic_l1": Study(
        schemas.read_churn_with_header, _logistic("l1"), C.SHARE_FIFTH, exact=True,
        scaling="standard", balanced=True,
    ),
    "renewal_linear": Study(
        _renewal_by_text, _logistic(), C.SHARE_FIFTH, exact=True,
        impute=True, scaling="standard",
    ),
    "renewal_logistic_l2": Study(
        _renewal_by_text, _logistic("l2"), C.SHARE_THREE_TENTHS, exact=True,
        impute=True, scaling="standard", balanced=True,
    ),
}


def run_study(
    spark: SparkSession,
    name: str,
    path: str,
    key: Sequence[str] | None = None,
    seed: int = DEFAULT_SEED,
    fill: str | None = None,
) -> Result:
    """Run a study on a file or folder.

    ``key`` names the columns that identify a row for the split; by default all of them, so that
    equal rows share a side. Everything is fitted on training rows only. ``fill`` says what becomes
    of a missing or unreadable feature cell: ``'error'``, ``'mean'`` (of the training rows) or
    ``'zero'``; by default what the study says. A missing label is always an error.
    """
    study = STUDIES[name]
    return fit_and_score(study, study.read(spark, path), key, seed, fill)


def fit_and_score(
    study: Study,
    table: DataFrame,
    key: Sequence[str] | None = None,
    seed: int = DEFAULT_SEED,
    fill: str | None = None,
) -> Result:
    fill = fill or ("mean" if study.impute else "error")
    if fill not in FILLS:
        raise ValueError(f"fill is one of {FILLS}, not {fill!r}")
    divide = split_exact if study.exact else split
    features = cols.names_except(table, study.excluded)
    # The passes of the split, and those that fill train and test, type and hash the cells once.
    key, hashed = key or table.columns, _new_name(table, "key_hash")
    (table,) = keep_in_memory(table.withColumn(hashed, key_hash(key, seed)))
    train, test = divide(table, key, study.share, seed, hashed)
    train, test = keep_in_memory(cols.keep(train, [*features, "label"]), test)

    empty = columns_without_values(train, features) if fill == "mean" else []
    features = [c for c in features if c not in empty]
    label = "label_index" if study.labels else "label"
    learner = study.learner(
        len(features), label, "weight" if study.balanced else None, seed
    )
    flags = [c for c in features if isinstance(table.schema[c].dataType, BooleanType)]
    stages = classification_stages(
        learner, features, study.labels, scaling=study.scaling, categories=study.categories,
        impute=fill == "mean", zeros=fill == "zero", flags=flags,
    )
    rows = with_class_weight(train, train, "label") if study.balanced else train
    model = stages.fit(rows)
    return Result(model, train, test, model.transform(test), label, tuple(empty), table)


def _new_name(table: DataFrame, name: str) -> str:
    taken = {c.lower() for c in table.columns}
    while name in taken:
        name = f"_{name}"
    return name


def renewal_correlations(spark: SparkSession, path: str) -> DataFrame:
    """The features that correlate most with the renewal code, before any filling."""
    table = schemas.read_renewal_with_header(spark, path, C.RENEWAL_HEADER_CODE)
    return top_correlations(table, C.RENEWAL_HEADER_CODE, C.RENEWAL_FEATURES)
