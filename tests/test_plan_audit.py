"""Whole-stage codegen for the report queries whose plans were reworked to
stay inside it (correlation unpivot, payment-share grid, histogram range)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from sf_paths import SF_SMALL  # noqa: E402
from plan_audit import outside_codegen  # noqa: E402


@pytest.mark.parametrize("name", ["correlation_matrix", "payment_share", "rating_histogram",
                                  "cohort_retention", "sql_yearly_revenue", "headline_metrics"])
def test_query_runs_inside_codegen(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    bad, python = outside_codegen(df._jdf.queryExecution().executedPlan())
    assert not bad and not python, (name, bad)
