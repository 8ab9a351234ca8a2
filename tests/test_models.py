"""Model rules on small tables: full loads, increments, late rows, newest wins, audit dates."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vaultline.operators.incremental import upsert
from vaultline.plans import models as M

RAW_A = ("AccountID string, AccountType string, Balance string, CustomerID string, _ingested_at string, "
         "_source_file string, _file_hash string, _row_number int")
RAW_C = ("CustomerID string, Name string, HasLoan string, _ingested_at string, _source_file string, "
         "_file_hash string, _row_number int")
STR_A = ("account_id string, account_type string, original_balance decimal(15,2), customer_id string, "
         "created_date string, modified_date string, metadata_json string, _last_processed_at string")
STR_C = ("customer_id string, customer_name string, hasloan boolean, created_date string, modified_date string, "
         "metadata_json string, _last_processed_at string")
T1, T2 = "2024-01-01 10:00:00", "2024-01-02 10:00:00"
SPRING, SUMMER, RUN = "2023-04-03 08:15:00", "2023-07-19 17:40:00", "2023-08-01 00:00:00"


def _ts(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def str_a(spark, data):
    return _ts(spark.createDataFrame(data, STR_A), "created_date", "modified_date", "_last_processed_at")


def str_c(spark, data):
    return _ts(spark.createDataFrame(data, STR_C), "created_date", "modified_date", "_last_processed_at")


def raw_accounts(spark, *given):
    """(id, type, balance, customer, when) as raw rows, numbered in the order given."""
    return spark.createDataFrame([(i, t, b, c, when, f"{when[:10]}.csv", f"md5-{when[:10]}", n)
                                  for n, (i, t, b, c, when) in enumerate(given, 1)], RAW_A)


def raw_customers(spark, *given):
    """(id, name, loan, when) as raw rows."""
    return spark.createDataFrame([(i, n, loan, when, f"{when[:10]}.csv", f"md5-{when[:10]}", k)
                                  for k, (i, n, loan, when) in enumerate(given, 1)], RAW_C)


def accounts(spark, *given):
    """(id, type, balance, customer, modified) as structured rows created in spring."""
    return str_a(spark, [(i, t, Decimal(b), c, SPRING, when, "{}", when) for i, t, b, c, when in given])


def customers(spark, *given):
    """(id, name, loan, modified) as structured rows."""
    return str_c(spark, [(i, n, loan, SPRING, when, "{}", when) for i, n, loan, when in given])


# ---- structured

KNOWN = ("S-17", "savings", "820.40", "K4", SPRING)


@pytest.mark.parametrize("known,delivered,expected", [
    ([], [KNOWN, ("G-2", "checking", "64", "K9", SPRING)], [("G-2", "checking", "64.00", "K9"), ("S-17", "savings", "820.40", "K4")]),
    ([KNOWN], [KNOWN, ("S-90", "savings", "12.5", "K1", SUMMER)], [("S-90", "savings", "12.50", "K1")]),
    ([KNOWN], [KNOWN], []),
    ([], [KNOWN, ("S-17", "savings", "1,910.05", "K4", SUMMER)], [("S-17", "savings", "1910.05", "K4")]),
    ([], [("S-17", "savings", "3", "K4", SUMMER), KNOWN], [("S-17", "savings", "3.00", "K4")]),
], ids=["first load", "only the new account", "nothing new", "newest delivery wins", "whatever the order"])
def test_str_accounts(spark, known, delivered, expected):
    existing = accounts(spark, *known) if known else None
    out = M.str_accounts(raw_accounts(spark, *delivered), existing, RUN)
    assert rows(out, "account_id", "account_type", "original_balance", "customer_id") == [
        (i, t, Decimal(b), c) for i, t, b, c in expected]


def test_str_accounts_cleansing_and_flags(spark):
    raw = spark.createDataFrame([
        (" A1 ", " SAVINGS", "1,000.50", "C1 ", T1, "f", "h", 1),
        ("A2", "Checking", None, "C2", T1, "f", "h", 2),
        ("A3", "savings", "abc", "C3", T1, "f", "h", 3),
        ("   ", "savings", "1", "C4", T1, "f", "h", 4),
        (None, "savings", "1", "C5", T1, "f", "h", 5)], RAW_A)
    out = M.str_accounts(raw, None, "2025-01-01 00:00:00")
    assert rows(out, "account_id", "account_type", "original_balance", "customer_id", "data_quality_flag") == [
        ("A1", "savings", Decimal("1000.50"), "C1", "VALID"),
        ("A2", "checking", Decimal("0.00"), "C2", "IMPUTED_NULL_BALANCE"),
        ("A3", "savings", Decimal("0.00"), "C3", "IMPUTED_NULL_BALANCE")]
    meta = out.filter("account_id = 'A1'").first()["metadata_json"]
    assert meta == ('{"source_file":"f","row_number":"1","file_hash":"h","ingested_at":"2024-01-01 10:00:00",'
                    '"data_quality_flag":"VALID"}')


def test_str_accounts_same_time_later_row_wins(spark):
    raw = spark.createDataFrame([("A1", "savings", "1", "C1", T1, "f", "h", 1),
                                 ("A1", "savings", "2", "C1", T1, "f", "h", 2)], RAW_A)
    assert rows(M.str_accounts(raw), "original_balance") == [(Decimal("2.00"),)]


def test_str_accounts_keeps_the_creation_date(spark):
    out = M.str_accounts(raw_accounts(spark, ("S-17", "savings", "77", "K4", SUMMER)), accounts(spark, KNOWN), RUN).first()
    assert (str(out["created_date"]), str(out["modified_date"])) == (SPRING, RUN)


MARA = ("K4", "mara  vogel", "y", SPRING)


@pytest.mark.parametrize("known,delivered,expected", [
    (False, [MARA, ("K9", "TOMÁS prieto", "n", SPRING)], [("K4", "Mara Vogel", True), ("K9", "Tomás Prieto", False)]),
    (True, [MARA, ("K1", "ines", "1", SUMMER)], [("K1", "Ines", True)]),
    (True, [MARA], []),
    (False, [MARA, ("K4", "mara klein", "no", SUMMER)], [("K4", "Mara Klein", False)]),
], ids=["first load", "only the new customer", "nothing new", "newest delivery wins"])
def test_str_customers(spark, known, delivered, expected):
    existing = customers(spark, ("K4", "Mara Vogel", True, SPRING)) if known else None
    out = M.str_customers(raw_customers(spark, *delivered), existing, RUN)
    assert rows(out, "customer_id", "customer_name", "hasloan") == expected


# ---- curated: fact

@pytest.mark.parametrize("balance,loan,rate,interest", [
    ("9999.99", False, "0.0100", "100.00"), ("10000.00", False, "0.0150", "150.00"), ("20000.00", False, "0.0150", "300.00"),
    ("20000.01", False, "0.0200", "400.00"), ("640.00", True, "0.0150", "9.60"), ("31000.00", True, "0.0250", "775.00"),
    ("-50.00", False, "0.0100", "-0.50"), ("0.00", True, "0.0150", "0.00")])
def test_interest_by_balance_and_loan(spark, balance, loan, rate, interest):
    acc = accounts(spark, ("S-17", "savings", balance, "K4", SPRING))
    r = M.fact_customer_balances(acc, customers(spark, ("K4", "Mara Vogel", loan, SPRING))).first()
    assert (r["interest_rate"], r["annual_interest"]) == (Decimal(rate), Decimal(interest))
    assert r["new_balance"] == Decimal(balance) + Decimal(interest)


def _people(spark):
    return customers(spark, ("K4", "Mara Vogel", False, SPRING), ("K9", "Tomás Prieto", True, SPRING))


def _priced(spark, balance="820.40"):
    return _ts(spark.createDataFrame([("S-17", "savings", Decimal(balance), "K4", SPRING, SPRING)],
                                     "account_id string, account_type string, original_balance decimal(15,2), "
                                     "customer_id string, created_date string, modified_date string"),
               "created_date", "modified_date")


def test_fact_takes_savings_accounts_of_known_customers(spark):
    acc = accounts(spark, KNOWN, ("G-2", "checking", "64", "K9", SPRING), ("S-3", "savings", "15250", "K9", SPRING),
                   ("S-8", "savings", "1", "nobody", SPRING))
    assert rows(M.fact_customer_balances(acc, _people(spark)), "account_id", "interest_rate", "annual_interest") == [
        ("S-17", Decimal("0.0100"), Decimal("8.20")), ("S-3", Decimal("0.0200"), Decimal("305.00"))]


@pytest.mark.parametrize("now,expected", [
    ([KNOWN, ("S-3", "savings", "15250", "K9", SUMMER)], [("S-3", Decimal("305.00"), RUN)]),
    ([("S-17", "savings", "2000", "K4", SUMMER)], [("S-17", Decimal("20.00"), SPRING)]),
    ([KNOWN], []),
], ids=["new account", "changed account keeps its creation date", "unchanged account"])
def test_fact_increment(spark, now, expected):
    out = M.fact_customer_balances(accounts(spark, *now), _people(spark), _priced(spark), RUN)
    got = [(r.account_id, r.annual_interest, str(r.created_date)) for r in out.collect()]
    assert got == expected


def test_fact_refresh_on_both_picks_up_loan_change(spark):
    acc, loan_now = accounts(spark, KNOWN), customers(spark, ("K4", "Mara Vogel", True, SUMMER))
    assert M.fact_customer_balances(acc, loan_now, _priced(spark)).count() == 0  # accounts alone decide by default
    out = M.fact_customer_balances(acc, loan_now, _priced(spark), refresh_on="both")
    assert rows(out, "account_id", "interest_rate") == [("S-17", Decimal("0.0150"))]


# ---- curated: dimensions

def test_dim_account(spark):
    first = M.dim_account(accounts(spark, KNOWN, ("G-2", "checking", "64", "K9", SPRING)))
    assert rows(first, "account_id", "account_type") == [("G-2", "checking"), ("S-17", "savings")]
    later = accounts(spark, KNOWN, ("G-2", "checking", "65", "K9", SUMMER), ("M-1", "money_market", "5", "K1", SPRING))
    assert rows(M.dim_account(later, first), "account_id", "original_balance") == [("G-2", Decimal("65.00")), ("M-1", Decimal("5.00"))]
    assert M.dim_account(accounts(spark, KNOWN), first).count() == 0
    assert rows(M.modified_since(later, first), "account_id") == [("G-2",), ("M-1",), ("S-17",)]


def test_dim_customer(spark):
    first = M.dim_customer(_people(spark))
    assert rows(first, "customer_id") == [("K4",), ("K9",)]
    later = customers(spark, ("K4", "Mara Klein", True, SUMMER), ("K9", "Tomás Prieto", True, SPRING), ("K1", "Ines", False, SUMMER))
    assert rows(M.dim_customer(later, first), "customer_name", "hasloan") == [("Ines", False), ("Mara Klein", True)]
    assert M.dim_customer(_people(spark), first).count() == 0


def test_upsert_replaces_and_inserts(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert rows(upsert(old, new, "k")) == [("a", 1), ("b", 20), ("c", 30)]


def test_account_summary_case_insensitive_and_ordered(spark):
    fact = spark.createDataFrame(
        [("A2", "C1", "n", "SAVINGS", Decimal("1"), False, Decimal("0.01"), Decimal("0.01"), Decimal("1.01")),
         ("A1", "C1", "n", "savings", Decimal("1"), False, Decimal("0.01"), Decimal("0.01"), Decimal("1.01")),
         ("A3", "C0", "n", "checking", Decimal("1"), False, Decimal("0.01"), Decimal("0.01"), Decimal("1.01"))],
        "account_id string, customer_id string, customer_name string, account_type string, "
        "original_balance decimal(15,2), hasloan boolean, interest_rate decimal(5,4), "
        "annual_interest decimal(15,2), new_balance decimal(15,2)")
    out = [tuple(r)[:2] for r in M.account_summary(fact).collect()]
    assert out == [("C1", "A1"), ("C1", "A2")]


def test_incremental_in_three_deliveries_equals_full_load(spark):
    """Deliveries in ingestion order (no late rows): merged increments == one full load."""
    from conftest import SF_SMALL

    from vaultline.sources import testdata as T
    raw = T.raw_accounts(spark, SF_SMALL)
    cuts = ["1994-01-01", "1996-06-01"]
    parts = [raw.filter(f"_ingested_at < '{cuts[0]}'"),
             raw.filter(f"_ingested_at >= '{cuts[0]}' and _ingested_at < '{cuts[1]}'"),
             raw.filter(f"_ingested_at >= '{cuts[1]}'")]
    table, seen = None, None
    for i, _ in enumerate(parts):
        seen = parts[0] if seen is None else seen.unionByName(parts[i])  # raw is append-only
        delta = M.str_accounts(seen, table, f"2025-01-0{i + 1} 00:00:00")
        table = delta if table is None else upsert(table, delta, "account_id")
        table = spark.createDataFrame(table.collect(), table.schema)  # committed state
    cols = ("account_id", "account_type", "original_balance", "customer_id", "data_quality_flag",
            "metadata_json", "_last_processed_at")
    assert rows(table, *cols) == rows(M.str_accounts(raw), *cols)
