"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keepsake.session import new_shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a plan without the steps before, whose
    rows no lost executor takes along."""
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
