"""Landing files written from the driver's test data (for ingestion queries and tests).

Accounts are delivered by order month, customers by nation, and each delivery is cut
into files by ranges of ``SLICE`` source keys, so no file or task grows with the data.
Rows are in key order inside a file, so per-file row numbers are reproducible in SQL:
``row_number() over (partition by month, slice order by o_orderkey)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.sources import testdata as T
from vaultline.sources.landing import CSV_TEXT

MONTH = "date_format(o_orderdate, 'yyyy-MM')"
# Source keys a file covers.
SLICE = 1_000_000


def account_source_rows(spark: SparkSession, sf: str, extra_priority: bool = False) -> DataFrame:
    """Raw-account text columns plus the delivery month, the slice and the order key (for ordering)."""
    orders = T.read_table(spark, sf, "orders")
    raw = spark.sql(T.RAW_ACCOUNTS_SQL.replace(
        "o_orderdate as _ingested_at",
        f"o_orderdate as _ingested_at, {MONTH} as month, o_orderkey as okey, o_orderpriority as Priority"),
        orders=orders)
    cols = ["AccountID", "CustomerID", "Balance", "AccountType"] + (["Priority"] if extra_priority else [])
    return raw.select(*cols, "month", F.expr(f"okey div {SLICE}").alias("slice"), "okey")


def customer_source_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Raw-customer text columns plus the delivery (nation), the slice and the customer key."""
    cust = T.read_table(spark, sf, "customer")
    raw = spark.sql(T.RAW_CUSTOMERS_SQL.replace(
        "cast(c_custkey + 1 as int) as _row_number",
        "cast(c_custkey + 1 as int) as _row_number, cast(c_nationkey as string) as nation, c_custkey as okey"),
        customer=cust)
    return raw.select("CustomerID", "Name", "HasLoan", "nation", F.expr(f"okey div {SLICE}").alias("slice"), "okey")


def write_csv(df: DataFrame, path: str, part: str = "month", mode: str = "overwrite", **options) -> None:
    """One CSV file per delivery and slice, rows ordered by ``okey``; text written verbatim."""
    (df.repartition(part, "slice").sortWithinPartitions(part, "slice", "okey").drop("okey")
       .write.mode(mode).partitionBy(part, "slice").options(**CSV_TEXT).options(**options).option("header", True).csv(path))


def month_of(path_col) -> F.Column:
    return F.regexp_extract(path_col, r"month=([0-9]{4}-[0-9]{2})", 1)
