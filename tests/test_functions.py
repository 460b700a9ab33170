import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keepsake.functions import cells, labels, scores
from keepsake.functions.keys import share_bound

CELLS = {
    # cell: (number, flag, is_yes)
    "yes": (None, True, True),
    "no": (None, False, False),
    "Yes": (None, None, False),
    " 2 ": (2.0, None, False),
    "1e3": (1000.0, None, False),
    "1.0d": (None, None, False),
    "1f": (None, None, False),
    "nan": (None, None, False),
    "inf": (math.inf, None, False),
    "-Infinity": (-math.inf, None, False),
    "0x10": (None, None, False),
    "0x1p3": (None, None, False),
    "1_0": (None, None, False),
    "": (None, None, False),
    "382-4657": (None, None, False),
    None: (None, None, False),
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cells(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cell = F.col("cell")
        rows = (
            spark.createDataFrame([(c,) for c in CELLS], "cell string")
            .select(
                cell,
                cells.to_double(cell).alias("number"),
                cells.to_double_or_zero(cell).alias("zeroed"),
                cells.to_flag(cell).alias("flag"),
                cells.is_yes(cell).alias("yes"),
                cells.to_type(cell, "string").alias("text"),
            )
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert {r.cell: (r.number, r.flag, r.yes) for r in rows} == CELLS
    assert all(r.zeroed == (r.number or 0.0) for r in rows)
    assert all(r.text == r.cell for r in rows)


def test_cells_of_an_undeclared_type_are_refused():
    with pytest.raises(ValueError):
        cells.to_type(None, "date")


def test_column_takes_any_name(spark):
    name = "Int'l `Plan`. 2?"
    df = spark.createDataFrame([(1,)], [name])
    assert df.select(cells.column(name)).first()[0] == 1


def test_labels(spark):
    rows = spark.createDataFrame(
        [("Renewers", 3), ("renewers", 2), ("Lapsed", 1), (None, None)], "t string, c int"
    ).select(
        labels.one_vs_rest(F.col("t"), "Renewers", "Others").alias("t"),
        labels.equals_label(F.col("t"), "Renewers").alias("text"),
        labels.equals_label(F.col("c"), 3).alias("code"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("Renewers", 1.0, 1.0), ("Others", 0.0, 0.0), ("Others", 0.0, 0.0), ("Others", 0.0, 0.0)
    ]


def test_label_literal_needs_its_dot(spark):
    rows = spark.createDataFrame([("True.",), ("True",), ("False.",)], "t string").select(
        labels.equals_label(F.col("t"), "True.").alias("y")
    ).collect()
    assert [r.y for r in rows] == [1.0, 0.0, 0.0]


def test_softmax_and_argmax(spark):
    rows = spark.createDataFrame(
        [([1.0, 3.0, 3.0],), ([1000.0, 0.0, -1000.0],)], "s array<double>"
    ).select(
        scores.softmax(F.col("s")).alias("p"), scores.argmax(F.col("s")).alias("top")
    ).collect()
    for row in rows:
        assert sum(row.p) == pytest.approx(1.0)
    powers = [math.exp(-2), 1.0, 1.0]
    assert rows[0].p == pytest.approx([p / sum(powers) for p in powers])
    assert [r.top for r in rows] == [1, 0]  # the first of two equal scores


def test_dense_and_element(spark):
    df = spark.createDataFrame([(Vectors.sparse(3, {1: 2.5}),)], ["v"])
    row = df.select(scores.dense(F.col("v")).alias("d"), scores.element(F.col("v"), 1)).first()
    assert row.d == Vectors.dense([0.0, 2.5, 0.0])
    assert type(row.d).__name__ == "DenseVector"
    assert row[1] == 2.5


def test_share_bound():
    assert share_bound(0.0) == "0" * 32
    assert share_bound(0.5) == "8" + "0" * 31
    assert share_bound(1.0) > "f" * 32
    with pytest.raises(ValueError):
        share_bound(1.5)
