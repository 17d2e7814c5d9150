"""Every registered query against its SQL over the same tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_queries_without_sql(spark):
    found = queries()
    own = {n for n in found if not n.startswith("op") and n != "pipeline"}
    model = {"model_scores", "model_held_out", "model_reliability"}
    assert own - set(oracle_sql()) == {"preview_gold", *model}
    assert found["preview_gold"](spark, SF_DIR).count() == 5
    measured = found["model_held_out"](spark, SF_DIR).first()
    scored = found["model_scores"](spark, SF_DIR)
    assert scored.count() == measured.held_out < found["gold"](spark, SF_DIR).count()
    assert scored.filter("converted").count() == measured.converted and 0 <= measured.auc <= 1
    bins = found["model_reliability"](spark, SF_DIR).collect()
    assert sum(r.sessions for r in bins) == measured.held_out


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "unique_session_id" and df.count() > 0
