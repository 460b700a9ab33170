import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake import constants as C
from keepsake.session import new_shared_path, shared_folder
from keepsake.sources import delimited, schemas, sinks

CHURN_LINE = (
    "KS,128,415,382-4657,no,yes,25,265.1,110,45.07,197.4,99,16.78,244.7,91,11.01,"
    "10,3,2.7,1,False."
)


def write(spark, tmp_path, *lines, name="in.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_unquoted_lines_cut_at_every_comma(spark, tmp_path):
    path = write(spark, tmp_path, '"a,b",no,True.', ",,", "single")
    rows = [r.cells for r in delimited.read_lines(spark, path).collect()]
    assert rows == [['"a', 'b"', "no", "True."], ["", "", ""], ["single"]]


def test_quoted_lines_keep_commas(spark, tmp_path):
    path = write(spark, tmp_path, '"a,b",no,True.')
    schema = T.StructType.fromDDL("x string, y boolean, z string")
    assert tuple(delimited.read_quoted(spark, path, schema).first()) == ("a,b", False, "True.")


def test_line_ends_inside_quotes_and_other_separators(spark, tmp_path):
    path = write(spark, tmp_path, 'a;b', '"x', 'y";2')
    read = delimited.read_with_header(
        spark, path, {"b": "double", "a": "string"}, separator=";", multi_line=True
    )
    assert [tuple(r) for r in read.collect()] == [(2.0, "x\ny")]
    path = write(spark, tmp_path, '"x', 'y";2', name="plain.csv")
    schema = T.StructType.fromDDL("a string, b double")
    read = delimited.read_quoted(spark, path, schema, separator=";", multi_line=True)
    assert [tuple(r) for r in read.collect()] == [("x\ny", 2.0)]


def test_separator_is_taken_literally(spark, tmp_path):
    path = write(spark, tmp_path, "a|b.c")
    assert delimited.read_lines(spark, path, "|").first().cells == ["a", "b.c"]


def test_short_row_gives_null(spark, tmp_path):
    path = write(spark, tmp_path, "1,2,3")
    schema = T.StructType.fromDDL("near double, far double")
    positions = {"near": 2, "far": 5}
    row = delimited.read_unquoted(spark, path, schema, positions).first()
    assert (row.near, row.far) == (3.0, None)
    row = delimited.read_unquoted(spark, path, schema, positions, fill="zero").first()
    assert (row.near, row.far) == (3.0, 0.0)
    with pytest.raises(ValueError):
        delimited.read_unquoted(spark, path, schema, positions, fill="mean")


def test_churn_file(spark, tmp_path):
    df = schemas.read_churn(spark, write(spark, tmp_path, CHURN_LINE))
    assert df.schema == schemas.churn_schema()
    assert len([c for c in df.columns if c not in C.CHURN_EXCLUDED]) == 17
    row = df.first()
    assert (row.state, row.phone, row.int_plan, row.vmail_plan) == ("KS", "382-4657", False, True)
    assert (row.day_mins, row.custserve_calls, row.label) == (265.1, 1.0, "False.")


def test_churn_file_with_header(spark, tmp_path):
    header = "State,Account Length,Area Code,Phone,Int'l Plan,VMail Plan,Day Mins,Churn?"
    path = write(
        spark, tmp_path, header,
        "KS,128,415,382-4657,no,yes,265.1,False.", "OH,107,415,371-7191,yes,Yes,bad,True.",
    )
    df = schemas.read_churn_with_header(spark, path)
    assert df.columns == ["Account Length", "Int'l Plan", "VMail Plan", "Day Mins", "label"]
    assert [tuple(r) for r in df.collect()] == [
        (128.0, False, True, 265.1, 0.0), (107.0, True, False, None, 1.0)
    ]


def renewal_line(**cells):
    line = ["-"] * 89
    for position, value in cells.items():
        line[int(position[1:])] = value
    return ",".join(line)


def test_renewal_file(spark, tmp_path):
    path = write(
        spark, tmp_path,
        renewal_line(p4="1", p20="2", p17="3", p80="4", p77="5", p81="6", p82="7", p86="8",
                     p87="9", p88="10", p78="Renewers"),
        renewal_line(p78="Other group"),
        "too,short",
    )
    rows = schemas.read_renewal(spark, path, fill="zero").collect()
    assert list(rows[0]) == [float(i) for i in range(1, 11)] + ["Renewers"]
    assert list(rows[1]) == [0.0] * 10 + ["Others"]
    assert list(rows[2]) == [0.0] * 10 + ["Others"]
    assert list(schemas.read_renewal(spark, path).collect()[1])[:10] == [None] * 10


def test_renewal_file_with_header(spark, tmp_path):
    names = [*reversed(C.RENEWAL_FEATURES), "extra", C.RENEWAL_HEADER_CODE]
    path = write(
        spark, tmp_path, ",".join(names), ",".join(str(i) for i in range(12)),
        ",".join([""] * 11 + ["3"]),
    )
    df = schemas.read_renewal_with_header(spark, path, C.RENEWAL_HEADER_CODE)
    assert df.columns == [*C.RENEWAL_FEATURES, C.RENEWAL_HEADER_CODE]
    assert [list(r) for r in df.collect()] == [
        [float(i) for i in range(9, -1, -1)] + [11.0], [None] * 10 + [3.0]
    ]


def test_only_named_columns_are_scanned(spark, tmp_path):
    path = write(spark, tmp_path, "a,b,c", "1,2,3")
    df = delimited.read_with_header(spark, path, {"c": "double"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c:string>" in plan


def test_lines_are_cut_once_per_row(spark, tmp_path):
    df = schemas.read_churn(spark, write(spark, tmp_path, CHURN_LINE))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(value") == 1
    assert "Python" not in plan


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b', 2.5), (2, None, None)], "id int, t string, x double")
    path = str(tmp_path / "out")
    sinks.write_csv(df.select("t", "x", "id"), path, ["id"])
    back = delimited.read_with_header(spark, path)
    assert back.columns == ["id", "t", "x"]
    assert sorted(tuple(r) for r in back.collect()) == [("1", 'a "q", b', "2.5"), ("2", None, None)]
    with pytest.raises(Exception):
        sinks.write_csv(df, path, ["id"])


def test_preview_is_stable(spark):
    df = spark.range(1000).repartition(7).withColumn("x", F.col("id") * 2)
    shown = sinks.preview(df, ["id"])
    assert [r.id for r in shown.collect()] == list(range(20))
    assert "TakeOrderedAndProject" in shown._jdf.queryExecution().executedPlan().toString()


def test_cached_tables_spill(spark):
    first, second = sinks.keep_in_memory(spark.range(3), spark.range(4))
    assert first.storageLevel.useDisk and second.storageLevel.useMemory
    first.unpersist(), second.unpersist()


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark))
    assert new_shared_path(spark, "x") != new_shared_path(spark, "x")
