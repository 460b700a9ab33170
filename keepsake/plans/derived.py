"""Study-shaped tables derived from the star-schema tables, and written as study files.

A customer with its orders is one churn row; a part with its line items is one renewal row. Both
labels follow a rule over the row's own numbers, so a study on them has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake import constants as C
from keepsake.session import new_shared_path

_RENEWAL_FIELDS = 89

# Which order priority plays which part of the day.
_PRIORITIES = {"day": "1-URGENT", "eve": "2-HIGH", "night": "3-MEDIUM", "int": "4-NOT SPECIFIED"}
_SERVICE_PRIORITY = "5-LOW"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer in the churn file's columns, flags and label as text.

    Orders are summed per customer before the join, so the join sees one row per key.
    """
    orders = table(spark, sf_dir, "orders")
    measures = []
    for part, priority in _PRIORITIES.items():
        chosen = F.col("o_orderpriority") == priority
        price = F.when(chosen, F.col("o_totalprice"))
        measures += [
            # Summed as whole cents: the result does not depend on the order of the rows.
            (F.sum(F.round(price * 100).cast("long")) / 100).alias(f"{part}_mins"),
            F.count_if(chosen).cast("double").alias(f"{part}_calls"),
            F.max(price).alias(f"{part}_charge"),
        ]
    history = orders.groupBy("o_custkey").agg(
        F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("double").alias(
            "account_length"
        ),
        F.count_if(F.col("o_orderstatus") == "P").cast("double").alias("vmail_message"),
        *measures,
        F.count_if(F.col("o_orderpriority") == _SERVICE_PRIORITY).cast("double").alias(
            "custserve_calls"
        ),
    )
    numbers = [c for c in history.columns if c != "o_custkey"]
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(history, customers.c_custkey == history.o_custkey, "left").select(
        "c_mktsegment", "c_nationkey", "c_name", "c_acctbal",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in numbers],
    )
    yes_no = lambda test: F.when(test, C.YES).otherwise(C.NO)
    churned = (F.col("custserve_calls") >= 4) | (F.col("day_mins") > 900_000)
    return joined.select(
        F.col("c_mktsegment").alias("state"),
        "account_length",
        F.col("c_nationkey").cast("double").alias("area_code"),
        F.col("c_name").alias("phone"),
        yes_no(F.col("c_acctbal") < 3000).alias("int_plan"),
        yes_no(F.col("vmail_message") >= 4).alias("vmail_plan"),
        "vmail_message",
        *[f"{part}_{m}" for part in _PRIORITIES for m in ("mins", "calls", "charge")],
        "custserve_calls",
        F.when(churned, C.CHURN_LABELS[1]).otherwise(C.CHURN_LABELS[0]).alias("label"),
    )


def renewal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part in the renewal columns, with a text label, a code, and missing cells."""
    items = table(spark, sf_dir, "lineitem")
    sums = items.groupBy("l_partkey").agg(
        F.count(F.lit(1)).cast("double").alias("nth_membership_period"),
        F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).cast("double").alias("Window"),
        F.max("l_quantity").alias("Usage_Days"),
        F.max("l_discount").alias("Supercategory_Ratio"),
        F.min("l_tax").alias("Intensity_Ratio"),
        F.sum("l_quantity").alias("Product_Article"),
        F.count_if(F.col("l_returnflag") == "R").cast("double").alias("Overview_Detail"),
        F.count_if(F.col("l_returnflag") == "A").cast("double").alias("Email_Open_R"),
        F.count_if(F.col("l_linestatus") == "O").cast("double").alias("Email_Clicked_R"),
    )
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", F.col("p_size").cast("double").alias("Browser_Researcher")
    )
    joined = parts.join(sums, parts.p_partkey == sums.l_partkey, "left")
    renews = (F.col("Product_Article") > 850) | (F.col("Overview_Detail") >= 14)
    numbers = {
        **{c: F.col(c) for c in C.RENEWAL_FEATURES},
        # Some parts have no researcher figure, some an empty usage cell.
        "Browser_Researcher": F.when(F.col("p_type") != "SMALL", F.col("Browser_Researcher")),
        "Usage_Days": F.when(F.col("Window") > 2000, F.col("Usage_Days")),
    }
    group = F.when(renews, C.RENEWAL_LABELS[1]).otherwise(F.col("p_type"))
    code = F.when(renews, C.RENEWAL_POSITIVE_CODE).when(F.col("p_type") == "SMALL", 1).otherwise(2)
    return joined.select(
        "p_partkey",
        *[numbers[c].alias(c) for c in C.RENEWAL_FEATURES],
        group.alias(C.RENEWAL_HEADER_LABEL),
        code.alias(C.RENEWAL_HEADER_CODE),
    )


# Header names for the churn columns; those that the study names are fixed, the rest follow suit.
_CHURN_HEADER = {
    "state": "State", "area_code": "Area Code", "phone": "Phone",
    "int_plan": "Int'l Plan", "vmail_plan": "VMail Plan", "label": "Churn?",
}


def write_churn_lines(spark: SparkSession, sf_dir: str) -> str:
    """Headerless, unquoted churn lines."""
    rows = churn_table(spark, sf_dir)
    return _write_lines(spark, rows, [F.col(c) for c in rows.columns], "churn-lines")


def write_churn_csv(spark: SparkSession, sf_dir: str) -> str:
    """Churn CSV with a header whose names hold an apostrophe, blanks and a question mark."""
    names = {c: c.replace("_", " ").title() for c in churn_table(spark, sf_dir).columns}
    rows = churn_table(spark, sf_dir).withColumnsRenamed({**names, **_CHURN_HEADER})
    path = new_shared_path(spark, "churn-csv")
    rows.write.csv(path, header=True)
    return path


def write_renewal_lines(spark: SparkSession, sf_dir: str) -> str:
    """Headerless renewal lines: the known columns at their positions, filler elsewhere."""
    rows = renewal_table(spark, sf_dir)
    fields = [F.lit("-")] * _RENEWAL_FIELDS
    for name, position in C.RENEWAL_POSITIONS.items():
        fields[position] = F.col(name)
    fields[C.RENEWAL_LABEL_POSITION] = F.col(C.RENEWAL_HEADER_LABEL)
    fields[0] = F.col("p_partkey")
    return _write_lines(spark, rows, fields, "renewal-lines")


def write_renewal_csv(spark: SparkSession, sf_dir: str) -> str:
    """Renewal CSV with a header."""
    path = new_shared_path(spark, "renewal-csv")
    renewal_table(spark, sf_dir).write.csv(path, header=True)
    return path


def _write_lines(spark: SparkSession, rows: DataFrame, fields, name: str) -> str:
    cells = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    path = new_shared_path(spark, name)
    rows.select(F.concat_ws(",", *cells).alias("value")).write.text(path)
    return path
