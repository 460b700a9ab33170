"""Feature stages. Every function returns an unfitted stage, so that a pipeline fits it on
training rows only and can be saved and applied to new tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.constants import MAX_CATEGORIES
from keepsake.functions.cells import column
from keepsake.functions.scores import dense
from keepsake.operators.ranks import FEW_VALUES, WideIndexer


def assemble(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    """Numbers and booleans to one vector, in the given order. A missing value is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def index_by_frequency(columns: Sequence[str], suffix: str = "_index") -> StringIndexer:
    """Text to index, the most frequent value first, ties in alphabetical order.

    All columns are counted in one pass. Values unseen in training, and NULL, get an index of
    their own past the last. Every value reaches the driver; for columns that may have more than
    some ten thousand, use `index_wide`.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        stringOrderType="frequencyDesc",
        handleInvalid="keep",
    )


def index_wide(
    columns: Sequence[str], suffix: str = "_index", order: str = "frequency", few: int = FEW_VALUES
) -> list[WideIndexer]:
    """Text to index as above, for columns of any number of values: one stage for each column.

    With about ``few`` values or fewer the fitted stage is MLlib's; beyond, values are numbered in
    tables and rows find theirs by a join. The indices are the same.
    """
    return [
        WideIndexer(inputCol=c, outputCol=c + suffix, order=order, few=few) for c in columns
    ]


def index_in_place(
    train: DataFrame, df: DataFrame, columns: Sequence[str], few: int = FEW_VALUES
) -> DataFrame:
    """Replace text columns of ``df`` by their frequency index in ``train``. Columns with more than
    about ``few`` values are indexed without bringing them to the driver."""
    counts = train.agg(
        *[F.approx_count_distinct(column(c).cast("string")) for c in columns]
    ).first()
    narrow = [c for c, n in zip(columns, counts) if n <= few]
    indexed = index_by_frequency(narrow).fit(train).transform(df) if narrow else df
    for stage in index_wide([c for c in columns if c not in narrow], few=few):
        indexed = stage.fit(train).transform(indexed)
    return _take_over(indexed, columns, "_index")


def one_hot(
    columns: Sequence[str], drop_last: bool = True, suffix: str = "_hot"
) -> OneHotEncoder:
    """Category indices to 0/1 vectors, several columns at once."""
    return OneHotEncoder(
        inputCols=list(columns), outputCols=[c + suffix for c in columns], dropLast=drop_last
    )


def one_hot_in_place(
    train: DataFrame, df: DataFrame, columns: Sequence[str], drop_last: bool = True
) -> DataFrame:
    """Replace index columns of ``df`` by 0/1 vectors sized by ``train``."""
    encoded = one_hot(columns, drop_last).fit(train).transform(df)
    return _take_over(encoded, columns, "_hot")


def label_one_hot(column_name: str, output: str) -> list[Estimator]:
    """The label as a 0/1 vector with one place per class, classes in alphabetical order. Every
    class reaches the driver; an unseen one, or NULL, is an error."""
    index = output + "_index"
    return [
        StringIndexer(inputCol=column_name, outputCol=index, stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[index], outputCols=[output], dropLast=False),
    ]


def label_one_hot_wide(column_name: str, output: str, few: int = FEW_VALUES) -> list[Estimator]:
    """The same for a label of any number of classes. An unseen class, or NULL, gets no place: its
    vector is all 0."""
    index = output + "_index"
    return [
        WideIndexer(inputCol=column_name, outputCol=index, order="alphabet", few=few),
        # The last index is that of the classes without a place.
        OneHotEncoder(inputCols=[index], outputCols=[output], dropLast=True),
    ]


def label_index(column_name: str, labels: Sequence[str], output: str) -> StringIndexerModel:
    """Label text to its place in ``labels``; (negative, positive) gives 0.0 and 1.0.

    The order is stated, not learnt, so the positive class cannot move with its frequency.
    Any other value is an error.
    """
    return StringIndexerModel.from_labels(
        list(labels), inputCol=column_name, outputCol=output, handleInvalid="error"
    )


def label_text(column_name: str, labels: Sequence[str], output: str) -> IndexToString:
    """Index back to label text."""
    return IndexToString(inputCol=column_name, outputCol=output, labels=list(labels))


def detect_categories(
    input_column: str, output: str, max_categories: int = MAX_CATEGORIES
) -> VectorIndexer:
    """Treat vector elements with few distinct values as categories and re-index them.

    A value unseen in training gets an extra bucket, so a tree needs at least
    ``max_categories + 1`` bins.
    """
    return VectorIndexer(
        inputCol=input_column, outputCol=output, maxCategories=max_categories, handleInvalid="keep"
    )


def standardize(
    input_column: str, output: str, center: bool = True, scale: bool = True, spread: str = "pop"
) -> Estimator:
    """Centre and/or scale a vector by the mean and deviation of the training rows.

    ``spread`` is ``'pop'`` (divide by n) or ``'sample'`` (divide by n - 1).
    """
    if spread not in ("pop", "sample"):
        raise ValueError(f"spread is 'pop' or 'sample', not {spread!r}")
    if spread == "pop" and scale:
        return PopulationScaler(input_column, output, center)
    return StandardScaler(inputCol=input_column, outputCol=output, withMean=center, withStd=scale)


class PopulationScaler(Estimator, HasInputCol, HasOutputCol):
    """Standard scaling by the population deviation.

    MLlib's scaler divides by the sample deviation, so its result is stretched by
    sqrt(n / (n - 1)). The fitted model consists of MLlib stages only and can be saved.
    """

    def __init__(self, input_column: str, output: str, center: bool = True):
        super().__init__()
        self._set(inputCol=input_column, outputCol=output)
        self.center = center

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        source, output = self.getInputCol(), self.getOutputCol()
        sampled = output + "_sampled"
        scaler = StandardScaler(
            inputCol=source, outputCol=sampled, withMean=self.center, withStd=True
        ).fit(dataset)
        n = dataset.count()
        stretch = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        factors = Vectors.dense([stretch] * len(scaler.std))
        product = ElementwiseProduct(scalingVec=factors, inputCol=sampled, outputCol=output)
        return PipelineModel(stages=[scaler, product])


def to_dense(df: DataFrame, column_name: str) -> DataFrame:
    """Replace a vector column by its dense form."""
    return df.withColumn(column_name, dense(column(column_name)))


def _take_over(df: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumns({c: column(c + suffix) for c in columns}).drop(
        *[c + suffix for c in columns]
    )
