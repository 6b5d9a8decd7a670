import pytest

import __spark_entry__ as contract
from tools.compare import compare, connect

ORACLES = {k: v for k, v in contract.oracle_sql().items() if k not in contract.CORPUS_QUERIES}
ROWS_ONLY = {"fit_linear", "fit_ridge", "fit_lasso", "fit_forest", "fit_gbt", "cross_validate", "score_residuals",
             "feature_importance", "linear_contributions", "vif", "score_orders", "fit_tuned"}


def test_every_query_has_sql_but_the_model_fits():
    assert set(contract.queries()) - set(ORACLES) - set(contract.CORPUS_QUERIES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_the_full_width(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 73
    assert df.count() > 0
    assert contract.entry(spark).schema == df.schema


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, data, name):
    good, note = compare(spark, connect(data), data, name, ORACLES[name])
    assert good, note
