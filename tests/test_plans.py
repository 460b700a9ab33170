"""What the plans of the registered queries must, and must not, contain."""

import pytest

from keepsake.plans.oracle import ORACLE
from keepsake.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Query: the columns its scan may read.
SCANNED = {
    "corr_topk": ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag"],
    "class_weights": ["c_mktsegment"],
    "accuracy": ["l_quantity", "l_discount", "l_returnflag"],
    "auc_roc": ["l_quantity", "l_discount", "l_returnflag"],
    "category_counts": ["o_orderstatus", "o_orderpriority"],
}


@pytest.mark.parametrize("name", SCANNED)
def test_only_needed_columns_are_read(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for line in text.splitlines():
        if "ReadSchema" in line:
            read = line.split("ReadSchema: struct<")[1].split(">")[0]
            assert sorted(f.split(":")[0] for f in read.split(",")) == sorted(SCANNED[name])


NARROW = [
    "yes_no_flags", "safe_cast_zero", "label_one_vs_rest", "row_subset", "split_hash",
    "split_exact", "split_quarter_ids", "impute_mean", "standardize", "center_only",
    "vector_assemble_dense", "label_index_freq", "label_index_multi", "label_decode",
    "onehot_features", "onehot_label", "auto_categorical_rows", "class_weight_column",
    "score_argmax", "score_softmax", "prediction_listing", "project_drop_rename",
]


@pytest.mark.parametrize("name", NARROW)
def test_row_by_row_queries_do_not_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Exchange" not in text
    assert "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_no_cross_joins_and_no_python_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
