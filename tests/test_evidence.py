"""Queries whose figures could be right by being empty must not be, on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entrypoint
from subscope.schemas import RAW_TABLES
from subscope.sources.bindings import BINDINGS, GIVEN, bound_table

RATES = ("kpi_upgrade_rate", "kpi_upgrade_rate_by_partner", "kpi_upgrade_rate_by_quarter", "kpi_churn_rate",
         "kpi_churn_rate_by_quarter", "report_sales_sliced")


@pytest.mark.parametrize("name", RATES)
def test_figures_are_not_all_zero(spark, sf_dir, name):
    rows = entrypoint.queries()[name](spark, sf_dir).collect()
    assert rows and any(isinstance(v, float) and v > 0 for r in rows for v in r)


@pytest.mark.parametrize("table", RAW_TABLES)
def test_raw_tables_hold_every_source_row(spark, sf_dir, table):
    binding = BINDINGS[table]
    given = spark.read.schema(GIVEN[binding.source]).parquet(f"{sf_dir}/{binding.source}.parquet")
    want = given.select(*binding.distinct).distinct() if binding.distinct else given
    assert bound_table(spark, sf_dir, table).count() == want.count()


def test_payments_reconcile_in_every_way(spark, sf_dir):
    states = entrypoint.queries()["reconcile_two_systems"](spark, sf_dir)
    assert states.count() > 2
