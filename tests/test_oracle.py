"""Registered queries against their DuckDB SQL on sf0.001 (the driver's gate runs sf0.01)."""

import pytest

from conftest import SF_SMALL

FAST = ["account_summary", "str_accounts_full", "str_customers_incremental", "dim_account_incremental",
        "fact_incremental", "merge_upsert", "title_case", "standardize_boolean", "parse_balance", "na_normalize",
        "lineage_json", "orphan_accounts_seeded", "process_stats", "gate_structured", "summary_statistics",
        "account_type_distribution", "dq_report", "dq_relationships", "detect_schema", "audit_history"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    from oracle_check import compare
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res.startswith("OK"), res
