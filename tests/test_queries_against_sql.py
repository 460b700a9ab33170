"""Every query against its SQL on the same tables, and every query without one for its rows."""

import pytest

import __spark_entry__ as contract
from keepsake.plans.oracle import ORACLE
from keepsake.plans.queries import QUERIES
from keepsake.plans.studies import STUDIES
from tests.compare import connect, differences

LEARNERS = [q for q in QUERIES if q not in ORACLE and not q.startswith("study_")]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) == []


@pytest.mark.parametrize("name", LEARNERS)
def test_learner_lists_every_held_out_document(spark, sf_dir, connection, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    expected = connection.execute(
        """SELECT doc_id, quality::DOUBLE FROM labels JOIN documents USING (doc_id)
           WHERE md5(concat_ws('|', 7, md5(text))) < '33333333'"""
    ).fetchall()
    assert sorted((r.doc_id, r.label) for r in rows) == sorted(expected)
    assert {r.prediction for r in rows} <= {0.0, 1.0}
    if "probability" in rows[0]:
        assert all(0.0 <= r.probability <= 1.0 for r in rows)


@pytest.mark.parametrize("name", sorted(STUDIES))
def test_study_beats_the_majority(spark, sf_dir, name):
    found = {r.metric: r.value for r in QUERIES[f"study_{name}"](spark, sf_dir).collect()}
    assert set(found) == {"accuracy", "balanced_accuracy", "area_under_roc", "area_under_pr"}
    assert found["area_under_roc"] > 0.6
    assert found["balanced_accuracy"] > 0.5


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["metric", "value"]
    assert result.count() == 4
