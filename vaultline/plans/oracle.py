"""DuckDB SQL for the correctness gate.

The same business rules written as plain SQL over the driver's registered
tables. Raw views are inlined as CTEs; run timestamps are fixed literals.
Money and rates are presented as DOUBLE, as in ``vaultline.plans.present``.
"""

from __future__ import annotations

from vaultline.sources.testdata import (
    CUSTOMER_UPDATE_SQL,
    FIRST_ACCOUNT_DELIVERY,
    RAW_ACCOUNTS_SQL,
    RAW_CUSTOMERS_SQL,
    duck_cte,
)

RUN_1 = "2025-01-01 00:00:00"
RUN_2 = "2025-01-02 00:00:00"


def lit_ts(t: str) -> str:
    return f"timestamp '{t}'"


def with_(*ctes: tuple[str, str]) -> str:
    return "with " + ",\n".join(f"{n} as (\n{body}\n)" for n, body in ctes)


RAW_A = ("raw_accounts", duck_cte(RAW_ACCOUNTS_SQL))
RAW_C = ("raw_customers", duck_cte(RAW_CUSTOMERS_SQL))
RAW_C_UPD = ("customer_updates", duck_cte(CUSTOMER_UPDATE_SQL))
RAW_A1 = ("raw_accounts_1", f"select * from raw_accounts where {FIRST_ACCOUNT_DELIVERY}")
RAW_C_ALL = ("raw_customers_all", "select * from raw_customers union all select * from customer_updates")


def clean_accounts_sql(src: str) -> str:
    return f"""
select account_id, account_type, coalesce(bal, cast(0 as decimal(15,2))) as original_balance, customer_id,
       case when bal is null then 'IMPUTED_NULL_BALANCE' else 'VALID' end as data_quality_flag,
       _source_file, _file_hash, _row_number, _ingested_at
from (select trim(cast(AccountID as varchar)) as account_id,
             lower(trim(cast(AccountType as varchar))) as account_type,
             try_cast(replace(trim(cast(Balance as varchar)), ',', '') as decimal(15,2)) as bal,
             trim(cast(CustomerID as varchar)) as customer_id,
             _source_file, _file_hash, _row_number, cast(_ingested_at as timestamp) as _ingested_at
      from {src}
      where AccountID is not null and trim(cast(AccountID as varchar)) <> '') x"""


TITLE_CASE_SQL = """nullif(array_to_string(list_transform(list_filter(string_split(trim(cast({c} as varchar)), ' '), lambda w: w <> ''),
       lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' '), '')"""

BOOL_SQL = "coalesce(lower(trim(cast({c} as varchar))) in ('yes', 'true', '1', 't', 'y'), false)"


def clean_customers_sql(src: str) -> str:
    return f"""
select trim(cast(CustomerID as varchar)) as customer_id,
       {TITLE_CASE_SQL.format(c='Name')} as customer_name,
       {BOOL_SQL.format(c='HasLoan')} as hasloan,
       _source_file, _file_hash, _row_number, cast(_ingested_at as timestamp) as _ingested_at
from {src}
where CustomerID is not null and trim(cast(CustomerID as varchar)) <> ''"""


def latest_sql(inner: str, key: str) -> str:
    return f"""select * from ({inner}) l
qualify row_number() over (partition by {key} order by _ingested_at desc, _row_number desc, _file_hash desc) = 1"""


def _since(src: str, existing: str | None, col: str, target_col: str) -> str:
    if existing is None:
        return src
    return (f"(select * from {src} where cast({col} as timestamp) > "
            f"(select coalesce(max({target_col}), timestamp '1900-01-01') from {existing}))")


def str_accounts_sql(src: str, existing: str | None, run: str) -> str:
    s = _since(src, existing, "_ingested_at", "_last_processed_at")
    created = f"coalesce(e.created_date, {lit_ts(run)})" if existing else lit_ts(run)
    join = f"left join {existing} e on e.account_id = d.account_id" if existing else ""
    return f"""
select d.account_id, d.account_type, d.original_balance, d.customer_id, d.data_quality_flag,
       {created} as created_date, {lit_ts(run)} as modified_date,
       cast(json_object('source_file', d._source_file, 'row_number', cast(d._row_number as varchar),
                        'file_hash', d._file_hash, 'ingested_at', cast(d._ingested_at as varchar),
                        'data_quality_flag', d.data_quality_flag) as varchar) as metadata_json,
       d._ingested_at as _last_processed_at
from ({latest_sql(clean_accounts_sql(s), 'account_id')}) d {join}"""


def str_customers_sql(src: str, existing: str | None, run: str) -> str:
    s = _since(src, existing, "_ingested_at", "_last_processed_at")
    created = f"coalesce(e.created_date, {lit_ts(run)})" if existing else lit_ts(run)
    join = f"left join {existing} e on e.customer_id = d.customer_id" if existing else ""
    return f"""
select d.customer_id, d.customer_name, d.hasloan,
       {created} as created_date, {lit_ts(run)} as modified_date,
       cast(json_object('source_file', d._source_file, 'row_number', cast(d._row_number as varchar),
                        'file_hash', d._file_hash, 'ingested_at', cast(d._ingested_at as varchar)) as varchar) as metadata_json,
       d._ingested_at as _last_processed_at
from ({latest_sql(clean_customers_sql(s), 'customer_id')}) d {join}"""


def upsert_sql(existing: str, updates: str, key: str) -> str:
    return f"""
select * from {existing} e where not exists (select 1 from {updates} u where u.{key} = e.{key})
union all by name
select * from {updates}"""


RATE_SQL = """cast(case when {b} < 10000 then 0.01 when {b} between 10000 and 20000 then 0.015 else {t3} end
     + case when {l} then 0.005 else 0 end as decimal(5,4))"""


def fact_sql(accounts: str, customers: str, existing: str | None, run: str, tier_3: str = "0.02") -> str:
    acc = f"(select * from {accounts} where account_type = 'savings')"
    acc = _since(acc, existing, "modified_date", "modified_date")
    created = f"coalesce(e.created_date, {lit_ts(run)})" if existing else lit_ts(run)
    join = f"left join {existing} e on e.account_id = p.account_id" if existing else ""
    return f"""
select p.account_id, p.customer_id, p.customer_name, p.account_type, p.original_balance, p.hasloan,
       p.interest_rate,
       cast(round(p.original_balance * p.interest_rate, 2) as decimal(15,2)) as annual_interest,
       cast(round(p.original_balance + cast(round(p.original_balance * p.interest_rate, 2) as decimal(15,2)), 2) as decimal(15,2)) as new_balance,
       {created} as created_date, {lit_ts(run)} as modified_date, p.metadata_json
from (select a.account_id, a.customer_id, c.customer_name, a.account_type, a.original_balance, c.hasloan,
             {RATE_SQL.format(b='a.original_balance', l='c.hasloan', t3=tier_3)} as interest_rate, a.metadata_json
      from {acc} a join {customers} c on a.customer_id = c.customer_id) p {join}"""


def summary_sql(fact: str) -> str:
    return f"""
select customer_id, account_id, cast(original_balance as double) as original_balance,
       cast(interest_rate as double) as interest_rate, cast(annual_interest as double) as annual_interest,
       cast(new_balance as double) as new_balance
from {fact} where lower(account_type) = 'savings'"""


# Full-load chain: raw → structured → curated, as CTEs.
FULL = [
    RAW_A, RAW_C,
    ("str_accounts", str_accounts_sql("raw_accounts", None, RUN_1)),
    ("str_customers", str_customers_sql("raw_customers", None, RUN_1)),
    ("fact", fact_sql("str_accounts", "str_customers", None, RUN_1)),
]

# Two-run chain: run 1 sees the first deliveries, run 2 everything.
TWO_RUNS = [
    RAW_A, RAW_C, RAW_C_UPD, RAW_A1, RAW_C_ALL,
    ("str_accounts_r1", str_accounts_sql("raw_accounts_1", None, RUN_1)),
    ("str_customers_r1", str_customers_sql("raw_customers", None, RUN_1)),
    ("str_accounts_d2", str_accounts_sql("raw_accounts", "str_accounts_r1", RUN_2)),
    ("str_customers_d2", str_customers_sql("raw_customers_all", "str_customers_r1", RUN_2)),
    ("str_accounts_r2", upsert_sql("str_accounts_r1", "str_accounts_d2", "account_id")),
    ("str_customers_r2", upsert_sql("str_customers_r1", "str_customers_d2", "customer_id")),
    ("fact_r1", fact_sql("str_accounts_r1", "str_customers_r1", None, RUN_1)),
    ("fact_d2", fact_sql("str_accounts_r2", "str_customers_r2", "fact_r1", RUN_2)),
    ("fact_r2", upsert_sql("fact_r1", "fact_d2", "account_id")),
]


def over(chain, select: str) -> str:
    return (with_(*chain) + "\n" + select) if chain else select

# Extra CTEs for curated deltas of the two-run chain.
DIM_ACC_R1 = ("dim_account_r1", "select account_id, account_type, original_balance, customer_id, created_date, "
              "modified_date, metadata_json from str_accounts_r1")
DIM_CUST_R1 = ("dim_customer_r1", "select customer_id, customer_name, hasloan, created_date, modified_date, "
               "metadata_json from str_customers_r1")


def money(*cols: str) -> str:
    """DuckDB ``* replace (...)`` list presenting decimals as DOUBLE."""
    return "replace (" + ", ".join(f"cast({c} as double) as {c}" for c in cols) + ")"


FACT_MONEY = money("original_balance", "interest_rate", "annual_interest", "new_balance")
