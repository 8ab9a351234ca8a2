"""Raw account / customer tables derived from the driver's test data.

The landing folders of the test data hold no account files, so raw tables are
derived from ``orders`` (account versions: two orders share an account key) and
``customer``. The SQL text is shared verbatim by Spark (``spark.sql`` with
DataFrame arguments) and by the DuckDB oracle (inlined as CTEs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the test data."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Raw-view definitions agreed for the test data (dirty ids with
# padding, comma-formatted and unparseable balances, mixed-case account types).
RAW_ACCOUNTS_SQL = """
select case when o_orderkey % 7 = 0 then concat(' ACC', cast(cast(floor(o_orderkey/2) as bigint) as string), ' ')
            else concat('ACC', cast(cast(floor(o_orderkey/2) as bigint) as string)) end as AccountID,
       case when o_orderkey % 11 = 0 then concat('CUS', cast(o_custkey as string), ' ')
            else concat('CUS', cast(o_custkey as string)) end as CustomerID,
       case when o_orderkey % 13 = 0 then cast(null as string)
            when o_orderkey % 17 = 0 then 'n/k'
            when o_orderkey % 5 = 0 and bc >= 100000
            then concat(cast(cast(floor(bc/100000) as bigint) as string), ',',
                        lpad(cast(cast(floor(bc/100) as bigint) % 1000 as string), 3, '0'), '.',
                        lpad(cast(bc % 100 as string), 2, '0'))
            else concat(cast(cast(floor(bc/100) as bigint) as string), '.',
                        lpad(cast(bc % 100 as string), 2, '0')) end as Balance,
       case when o_orderstatus = 'F' then 'Savings' when o_orderstatus = 'O' then ' SAVINGS'
            when o_orderkey % 2 = 0 then 'Checking' else 'MONEY_MARKET ' end as AccountType,
       'landing/accounts.csv' as _source_file, md5('accounts') as _file_hash,
       cast(o_orderkey + 1 as int) as _row_number, o_orderdate as _ingested_at
from (select *, cast(floor(cast(round(o_totalprice*100) as bigint)/10) as bigint) as bc from {orders}) o
"""

RAW_CUSTOMERS_SQL = """
select concat('CUS', cast(c_custkey as string)) as CustomerID,
       case when c_custkey % 3 = 0 then concat('  ', upper(c_name), '  ', lower(c_mktsegment), ' ')
            when c_custkey % 3 = 1 then concat(lower(c_name), ' ', c_mktsegment) else c_name end as Name,
       case c_custkey % 12 when 0 then 'Yes' when 1 then ' YES ' when 2 then 'true' when 3 then '1' when 4 then 'Y'
            when 5 then 't' when 6 then 'no' when 7 then 'None' when 8 then '' when 9 then 'n/a' when 10 then 'maybe'
            else cast(null as string) end as HasLoan,
       'landing/customers.csv' as _source_file, md5('customers') as _file_hash,
       cast(c_custkey + 1 as int) as _row_number, timestamp '2024-01-01 00:00:00' as _ingested_at
from {customer}
"""

# Second deliveries for the incremental scenarios. Accounts: the first file holds
# everything ingested before 1997 except checking accounts, whose file arrives
# late (at or before the watermark, so the watermark rule ignores it). Customers:
# an update file re-delivers every customer in arrears (c_acctbal < 0) a month
# later, now with a loan.
FIRST_ACCOUNT_DELIVERY = "_ingested_at < timestamp '1997-01-01 00:00:00' and AccountType <> 'Checking'"

CUSTOMER_UPDATE_SQL = """
select concat('CUS', cast(c_custkey as string)) as CustomerID,
       c_name as Name,
       'yes' as HasLoan,
       'landing/customers_update.csv' as _source_file, md5('customers_update') as _file_hash,
       cast(c_custkey + 1 as int) as _row_number, timestamp '2024-02-01 00:00:00' as _ingested_at
from {customer}
where c_acctbal < 0
"""


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_ACCOUNTS_SQL, orders=read_table(spark, sf_dir, "orders"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_CUSTOMERS_SQL, customer=read_table(spark, sf_dir, "customer"))


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CUSTOMER_UPDATE_SQL, customer=read_table(spark, sf_dir, "customer"))


def account_deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(first file, everything delivered later) — together the whole raw table."""
    raw = raw_accounts(spark, sf_dir)
    first = raw.filter(FIRST_ACCOUNT_DELIVERY)
    later = raw.filter(f"not coalesce({FIRST_ACCOUNT_DELIVERY}, false)")
    return first, later


def duck_cte(sql: str) -> str:
    """The same view text for DuckDB, where tables are registered views."""
    return sql.format(orders="orders", customer="customer")
