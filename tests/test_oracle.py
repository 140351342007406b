"""A representative set of registered queries against their DuckDB oracle (sf0.001).

``python tests/oracle_compare.py /root/testdata/sf0.01`` runs all of them.
"""
import re

import pytest

from conftest import SF_SMALL
from oracle_compare import compare

SUBSET = ["stg_invoices", "sat_subscription_details", "bv_customer_lifetime", "bv_subscription_health",
          "dim_customer", "fct_invoices", "fct_subscriptions", "mart_revenue", "mart_churn", "mart_usage",
          "obt_saas_metrics", "cohort_retention", "snp_customers_history", "sat_subscription_history",
          "fct_subscriptions_split_load", "metric_mrr", "dq_not_null", "dq_relationships"]


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=True)
    assert res[name][0] == "OK", res[name]


def test_every_query_has_an_oracle():
    import __spark_entry__ as e
    own = {q for q in e.queries() if q != "pipeline" and not re.match(r"op\d+_", q)}     # the others are optional
    assert own <= set(e.oracle_sql()) <= set(e.queries())


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert "wau_7d" in df.columns and "mau_28d" in df.columns
