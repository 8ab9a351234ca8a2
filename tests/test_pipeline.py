"""Golden sample end to end, idempotent re-run, incremental second delivery."""

import os
from decimal import Decimal

from pyspark.sql import functions as F

from vaultline.plans.runner import run_all
from vaultline.sinks.tables import VersionedTable

# The sample deliveries (with blank trailing lines) and the report they must give.
ACCOUNTS_CSV = """AccountID,CustomerID,Balance,AccountType
A001,101,10000,Savings
A002,102,20000,Checking
A003,103,10000,Savings
A004,104,,Savings
A005,105,30000,Checking
A006,105,15000,Savings
A007,106,5000,savings


"""
CUSTOMERS_CSV = """CustomerID,Name,HasLoan
101,alice smith,Yes
102,BOB JONES,no
103,  Charlie Brown ,YES
104,DAVID LEE,No
105,eve Adams,None
106,Frank O'Connor,yes


"""
EXPECTED = [
    ("101", "A001", 10000.0, 0.02, 200.0, 10200.0),
    ("103", "A003", 10000.0, 0.02, 200.0, 10200.0),
    ("104", "A004", 0.0, 0.01, 0.0, 0.0),
    ("105", "A006", 15000.0, 0.015, 225.0, 15225.0),
    ("106", "A007", 5000.0, 0.015, 75.0, 5075.0),
]


def _landing(tmp, name, text):
    d = os.path.join(tmp, "landing", name)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{name}.csv"), "w") as f:
        f.write(text)
    return d


def test_golden_sample_end_to_end(spark, tmp):
    acc_dir, cust_dir = _landing(tmp, "accounts", ACCOUNTS_CSV), _landing(tmp, "customers", CUSTOMERS_CSV)
    root, export = os.path.join(tmp, "warehouse"), os.path.join(tmp, "export")
    out = run_all(spark, root, acc_dir, cust_dir, "2025-01-01 00:00:00", export_path=export)
    assert out["raw_accounts"]["status"] == "completed"
    report = spark.read.option("header", True).schema(
        "customer_id string, account_id string, original_balance double, interest_rate double, "
        "annual_interest double, new_balance double").csv(export)
    assert [tuple(r) for r in report.collect()] == EXPECTED  # single ordered file
    names = {r[0]: r[1] for r in VersionedTable(spark, f"{root}/structured/str_customers").read()
             .select("customer_id", "customer_name").collect()}
    assert names == {"101": "Alice Smith", "102": "Bob Jones", "103": "Charlie Brown", "104": "David Lee",
                     "105": "Eve Adams", "106": "Frank O'connor"}
    flags = {r[0]: r[1] for r in VersionedTable(spark, f"{root}/structured/str_accounts").read()
             .select("account_id", "data_quality_flag").collect()}
    assert flags["A004"] == "IMPUTED_NULL_BALANCE" and flags["A001"] == "VALID"
    stats = out["statistics"]
    assert stats["row_count"] == 5 and stats["total_annual_interest"] == 700.0
    assert stats["total_original_balance"] == 40000.0 and stats["total_new_balance"] == 40700.0

    # Same files again: ingestion skips them, layers are unchanged.
    again = run_all(spark, root, acc_dir, cust_dir, "2025-01-02 00:00:00")
    assert again["raw_accounts"]["status"] == "skipped" and again["structured"] == "skipped"
    assert spark.read.parquet(f"{root}/raw/raw_accounts").count() == 7
    fact = VersionedTable(spark, f"{root}/curated/fact_customer_balances").read()
    assert fact.count() == 5

    # A second accounts file: A001 grows, A008 is new; created dates are kept.
    with open(os.path.join(acc_dir, "accounts_2.csv"), "w") as f:
        f.write("AccountID,CustomerID,Balance,AccountType\nA001,101,\"25,000.00\",Savings\nA008,102,100,SAVINGS\n")
    third = run_all(spark, root, acc_dir, cust_dir, "2025-01-03 00:00:00", export_path=export + "3")
    assert third["structured"] == "processed"
    fact = VersionedTable(spark, f"{root}/curated/fact_customer_balances").read()
    a1 = fact.filter("account_id = 'A001'").first()
    assert a1["original_balance"] == Decimal("25000.00") and a1["interest_rate"] == Decimal("0.0250")
    assert str(a1["created_date"]) == "2025-01-01 00:00:00" and str(a1["modified_date"]) == "2025-01-03 00:00:00"
    assert fact.count() == 6
    log = VersionedTable(spark, f"{root}/curated/process_metadata").read()
    last = log.filter((F.col("target_table") == "str_accounts") &
                      (F.col("run_timestamp") == F.lit("2025-01-03 00:00:00").cast("timestamp_ntz"))).first()
    assert (last["records_processed"], last["records_inserted"], last["records_updated"]) == (2, 1, 1)


def test_access_checks_raise_on_error(spark, tmp):
    import pytest

    from vaultline.operators.quality import DataQualityError
    acc_dir = _landing(tmp, "accounts", "AccountID,CustomerID,Balance,AccountType\nA1,1,-5,savings\n")
    cust_dir = _landing(tmp, "customers", "CustomerID,Name,HasLoan\n1,x y,no\n")
    with pytest.raises(DataQualityError):
        run_all(spark, os.path.join(tmp, "wh"), acc_dir, cust_dir, "2025-01-01 00:00:00")
    out = run_all(spark, os.path.join(tmp, "wh2"), acc_dir, cust_dir, "2025-01-01 00:00:00", strict_access=False)
    assert out["checks_failed"] >= 1


def test_full_refresh_rebuilds_from_the_whole_raw_layer(spark, tmp):
    acc_dir, cust_dir = _landing(tmp, "accounts", ACCOUNTS_CSV), _landing(tmp, "customers", CUSTOMERS_CSV)
    root = os.path.join(tmp, "warehouse")
    run_all(spark, root, acc_dir, cust_dir, "2025-01-01 00:00:00")
    out = run_all(spark, root, acc_dir, cust_dir, "2025-01-05 00:00:00", full_refresh=True)
    assert out["structured"] == out["curated"] == "processed" and out["pair_ready"]
    fact = VersionedTable(spark, f"{root}/curated/fact_customer_balances").read()
    assert {str(r.created_date) for r in fact.collect()} == {"2025-01-05 00:00:00"} and fact.count() == 5


def test_a_run_waits_for_the_pair_and_stores_checks_and_failures(spark, tmp, monkeypatch):
    import pytest

    from vaultline.plans import models as M
    from vaultline.plans.ingest import Catalog
    acc_dir, cust_dir = _landing(tmp, "accounts", ACCOUNTS_CSV), os.path.join(tmp, "landing", "customers")
    os.makedirs(cust_dir)
    root = os.path.join(tmp, "warehouse")
    cat = Catalog(root)
    assert run_all(spark, root, acc_dir, cust_dir, "2025-01-01 00:00:00")["structured"] == "waiting"
    _landing(tmp, "customers", CUSTOMERS_CSV)

    def broken(*args, **kw):
        raise OSError("no dimension today")

    with monkeypatch.context() as m:
        m.setattr(M, "dim_customer", broken)
        with pytest.raises(OSError):
            run_all(spark, root, acc_dir, cust_dir, "2025-01-02 00:00:00")
    log = {(r.target_table, r.status): r for r in cat.process_log(spark).read().collect()}
    assert log["dim_customer", "failed"].error_message == "no dimension today"
    assert log["dim_account", "completed"].records_inserted == 7 and log["dim_account", "completed"].duration_seconds > 0
    # the next run finishes what that one left, the dimensions included, with either gate
    out = run_all(spark, root, acc_dir, cust_dir, "2025-01-03 00:00:00", gate="new_keys")
    assert out["structured"] == "skipped" and out["curated"] == "processed"
    assert cat.table(spark, "curated", "dim_customer").read().count() == 6
    assert cat.table(spark, "curated", "dim_account").read().count() == 7
    checks = cat.check_results(spark).read()
    assert checks.count() == 53 and checks.where("check_name in ('interest_calculation', 'only_savings', 'orphan_accounts')").count() == 3
    assert run_all(spark, root, acc_dir, cust_dir, "2025-01-04 00:00:00", gate="new_keys")["curated"] == "skipped"
