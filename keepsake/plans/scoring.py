"""Scoring new files with a saved model.

A fitted study is saved with what its features look like; a new file is read as the study reads its
own, checked against that, and scored by the saved pipeline. Nothing is fitted, and the file needs no
label.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.functions.cells import column
from keepsake.functions.scores import element
from keepsake.plans.studies import STUDIES, Result

_SAVED = "study string, label string, features string"


def save_model(result: Result, study: str, path: str) -> None:
    """Save the pipeline, and in its folder the study's name and the schema of its features."""
    result.model.save(path)
    unused = {"label", *result.dropped}
    features = T.StructType([f for f in result.train.schema if f.name not in unused])
    row = [(study, result.label, features.json())]
    result.train.sparkSession.createDataFrame(row, _SAVED).coalesce(1).write.json(f"{path}/study")


@dataclass(frozen=True)
class Scorer:
    """A saved model, ready for new rows."""

    study: str
    features: T.StructType
    pipeline: PipelineModel

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scorer:
        saved = spark.read.schema(_SAVED).json(f"{path}/study").first()
        if saved is None or saved["study"] not in STUDIES:
            raise ValueError(f"{path} holds no model of a study known here")
        # The label's own index is the one stage that new rows have nothing for.
        kept = [
            s for s in PipelineModel.load(path).stages
            if not (isinstance(s, StringIndexerModel) and s.getOutputCol() == saved["label"])
        ]
        features = T.StructType.fromJson(json.loads(saved["features"]))
        return cls(saved["study"], features, PipelineModel(kept))

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """A file or folder as the study reads it. Its label may be missing; it is not looked at."""
        return STUDIES[self.study].read(spark, path)

    def check(self, df: DataFrame) -> None:
        """Refuse a table without the features, or with other types, naming all that differs."""
        theirs = {f.name: f.dataType for f in df.schema}
        wrong = [
            f"{f.name} is missing" if f.name not in theirs else
            f"{f.name} is {theirs[f.name].simpleString()}, not {f.dataType.simpleString()}"
            for f in self.features if theirs.get(f.name) != f.dataType
        ]
        known = {*self.features.names, "label", *STUDIES[self.study].excluded}
        wrong += [f"{c} is not a feature of the model" for c in df.columns if c not in known]
        if wrong:
            raise ValueError("the table does not fit the model: " + "; ".join(wrong))

    def score(self, df: DataFrame) -> DataFrame:
        """The table with the columns of the pipeline added: prediction, probability and others.

        A missing cell is filled as in training, or fails where the study says so. Nothing is
        fitted, so a row's score depends on nothing but the row.
        """
        self.check(df)
        return self.pipeline.transform(df)

    def listing(self, df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
        """Key columns (by default all but the label) with the prediction, decoded where the study's
        label is text, and the positive class's probability."""
        key = key or [c for c in df.columns if c != "label"]
        scored = self.score(df)
        added = [c for c in ("prediction", "predicted_label") if c in scored.columns]
        taken = {*added, "probability"} & set(key)
        if taken:
            raise ValueError(f"the listing has its own {sorted(taken)}; choose other key columns")
        chance = element(F.col("probability"), 1).alias("probability")
        return scored.select(*[column(c) for c in [*key, *added]], chance)
