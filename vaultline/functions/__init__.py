"""Column-level building blocks (stay inside Catalyst; no Python UDFs)."""

from vaultline.functions.columns import (
    annual_interest,
    clean_key,
    interest_rate,
    lineage_json,
    na_to_null,
    new_balance,
    normalize_account_type,
    parse_balance,
    standardize_boolean,
    title_case,
)

__all__ = [
    "annual_interest",
    "clean_key",
    "interest_rate",
    "lineage_json",
    "na_to_null",
    "new_balance",
    "normalize_account_type",
    "parse_balance",
    "standardize_boolean",
    "title_case",
]
