"""Registered queries against DuckDB on the smallest test tables.

One or two queries per family by default; LAKEPLAN_ALL=1 runs every one.
"""

import os

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect

SF = os.environ.get("LAKEPLAN_SF", "/root/testdata/sf0.001")
QUICK = [
    "src1_incremental_ingest", "src2_lineage", "src4_csv_snapshot", "src6_date_spine", "snk1_partitioned_write",
    "exp5_stream_dual_output", "prj1_conform_lines", "prj2_standardise", "exp3_rule_metrics", "exp4_lines_quarantine",
    "exp4_balance", "ded1_latest_per_key", "ded2_dedupe_surplus", "ded4_latest_decision", "jon5_exists_flag",
    "jon6_anti_orphans", "jon8_pure_range", "jon11_active_grid", "jon14_asof_price", "jon15_nearest_site",
    "jon17_sales_fact", "agg1_sales_daily", "agg4_order_headers", "agg9_promotion_lift", "agg10_event_uplift",
    "agg12_service_level", "agg13_margin_monthly", "agg17_group_quantiles", "agg22_pivot_product_zone", "ord2_top_k",
    "win6_global_quintiles", "win7_dense_index", "win8_scd2", "win11_year_ago", "fn2_dates", "fn8_casts", "cal1_dim_date",
    "cal3_event_curve", "cal8_price_revisions", "cal9_cost_from_index", "sem4_sales_by_product", "sem5_order_measures",
    "sem6_inventory_measures", "fc5_seasonal_naive", "fc12_candidate_wape", "fc16_series_accuracy", "inv8_reorder",
    "inv9_policy_levels", "inv10_stock_ledger", "dq2_orphans", "dq6_gate_status", "rpt1_sales", "rpt20_event_growth",
    "rpt29_planner",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("LAKEPLAN_ALL") else QUICK


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetch_df()
    assert compare(got, want) == "ok"
    assert len(want) > 0 or name in {"rpt29_planner"}


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_lazy_and_stable(spark):
    df = entry.entry(spark)
    assert df.columns == ["zone", "net_revenue_cr"]
    assert df.count() == 5
