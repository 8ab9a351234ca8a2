"""Reusable column rules for cleansing and interest maths.

Each rule is written once as Spark SQL text (``*_sql`` builders) and exposed as a
``Column`` through ``F.expr``: the whole rule is one Catalyst expression tree,
built with one gateway call, compiled into whole-stage codegen. Arguments are
column names, or ``Sql`` fragments for nested expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from vaultline.tariff import DEFAULT_TARIFF, Tariff

MONEY = DecimalType(15, 2)
RATE = DecimalType(5, 4)

# Spellings that mean "true" after lower(trim(x)); every other
# value, NULL included, means false.
TRUE_TOKENS = ("yes", "true", "1", "t", "y")

# The default NA spellings of the pandas CSV reader, which the
# reference's ingestion applies before any SQL runs. Matched exactly (no trim).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


class Sql(str):
    """A Spark SQL expression fragment (as opposed to a column name)."""


def ref(c: str) -> str:
    """SQL reference for a column name (quoted) or a fragment (parenthesised)."""
    if isinstance(c, Sql):
        return f"({c})"
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError(f"expected a column name or Sql fragment, got {type(c).__name__}")


def literal_list(values) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def _text(c) -> str:
    return f"CAST({ref(c)} AS STRING)"


# ---------------------------------------------------------------- SQL builders

def na_to_null_sql(c) -> Sql:
    return Sql(f"CASE WHEN {ref(c)} IN ({literal_list(NA_TOKENS)}) THEN NULL ELSE {ref(c)} END")


def clean_key_sql(c) -> Sql:
    return Sql(f"trim({_text(c)})")


def normalize_account_type_sql(c) -> Sql:
    return Sql(f"lower(trim({_text(c)}))")


def parse_balance_sql(c) -> Sql:
    return Sql(f"try_cast(replace(trim({_text(c)}), ',', '') AS DECIMAL(15,2))")


def standardize_boolean_sql(c) -> Sql:
    return Sql(f"coalesce(lower(trim({_text(c)})) IN ({literal_list(TRUE_TOKENS)}), false)")


def title_case_sql(c) -> Sql:
    return Sql(
        "nullif(array_join(transform("
        f"filter(split(trim({_text(c)}), ' '), w -> w != ''), "
        "w -> concat(upper(substring(w, 1, 1)), lower(substring(w, 2)))), ' '), '')")


def interest_rate_sql(balance, hasloan, tariff: Tariff = DEFAULT_TARIFF) -> Sql:
    b, t = ref(balance), tariff
    return Sql(
        f"CAST(CASE WHEN {b} < {t.tier_2_floor} THEN {t.tier_1_rate} "
        f"WHEN {b} BETWEEN {t.tier_2_floor} AND {t.tier_2_ceiling} THEN {t.tier_2_rate} "
        f"ELSE {t.tier_3_rate} END "
        f"+ CASE WHEN {ref(hasloan)} THEN {t.loan_bonus_rate} ELSE 0 END AS DECIMAL(5,4))")


def annual_interest_sql(balance, rate) -> Sql:
    return Sql(f"CAST(round({ref(balance)} * {ref(rate)}, 2) AS DECIMAL(15,2))")


def new_balance_sql(balance, interest) -> Sql:
    return Sql(f"CAST(round({ref(balance)} + {ref(interest)}, 2) AS DECIMAL(15,2))")


def lineage_json_sql(*fields: tuple[str, str]) -> Sql:
    pairs = ", ".join(f"'{k}', {ref(v)}" for k, v in fields)
    return Sql(f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false'))")


# ---------------------------------------------------------------- Column rules

def na_to_null(c) -> Column:
    """NULL when the text is one of the CSV NA tokens, else the text unchanged."""
    return F.expr(na_to_null_sql(c))


def clean_key(c) -> Column:
    """Identifier cleanup: trim spaces."""
    return F.expr(clean_key_sql(c))


def normalize_account_type(c) -> Column:
    return F.expr(normalize_account_type_sql(c))


def parse_balance(c) -> Column:
    """Text balance → DECIMAL(15,2); thousands commas removed; garbage → NULL."""
    return F.expr(parse_balance_sql(c))


def standardize_boolean(c) -> Column:
    return F.expr(standardize_boolean_sql(c))


def title_case(c) -> Column:
    """Split on single spaces, drop empty words, capitalise the first letter of
    each word and lower the rest, join with one space; blank → NULL.

    Unlike ``initcap`` it collapses runs of spaces. Higher-order functions keep it
    a per-row expression: no explode, no shuffle.
    """
    return F.expr(title_case_sql(c))


def interest_rate(balance, hasloan, tariff: Tariff = DEFAULT_TARIFF) -> Column:
    """Tier rate by balance (tier 2 inclusive on both ends) + loan bonus, DECIMAL(5,4)."""
    return F.expr(interest_rate_sql(balance, hasloan, tariff))


def annual_interest(balance, rate) -> Column:
    return F.expr(annual_interest_sql(balance, rate))


def new_balance(balance, interest) -> Column:
    return F.expr(new_balance_sql(balance, interest))


def lineage_json(*fields: tuple[str, str]) -> Column:
    """JSON object with a fixed key order, NULL values kept (``{"k":null}``)."""
    return F.expr(lineage_json_sql(*fields))
