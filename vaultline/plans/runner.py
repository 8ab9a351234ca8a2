"""End-to-end run: raw → structured → curated → access, in dependency order.

One SparkSession, plain function calls. Each layer reads what the previous
layer committed, so a failed step can be re-run alone; ingestion is idempotent
(file hashes), merges are versioned. Every target's merge is one row of the process
log, failed ones with their error; every run's check results are stored.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.operators import quality as Q
from vaultline.operators.incremental import _ntz, new_keys, since_watermark
from vaultline.plans import models as M
from vaultline.plans.gates import any_pending, pair_gate
from vaultline.plans.ingest import ACCOUNTS, CUSTOMERS, Catalog, ingest
from vaultline.plans.present import present
from vaultline.session import materialize
from vaultline.sinks.export import export_csv, summary_statistics
from vaultline.sinks.ledgers import check_rows, process_row, process_stats
from vaultline.sinks.tables import raw_exists, read_raw
from vaultline.tariff import DEFAULT_TARIFF, Tariff


MERGED = (("structured", "str_accounts"), ("structured", "str_customers"), ("curated", "dim_account"),
          ("curated", "dim_customer"), ("curated", "fact_customer_balances"))


def _pending(raw: DataFrame, existing: DataFrame | None, key_raw: str, key: str, gate: str) -> DataFrame:
    """Raw rows (or, with ``gate="new_keys"``, keys absent from the target) still to process."""
    if existing is None:
        return raw
    if gate == "new_keys":
        return new_keys(raw.filter(F.trim(F.col(key_raw)) != ""), existing, F.trim(raw[key_raw]), key)
    return since_watermark(raw, "_ingested_at", existing, "_last_processed_at")


def _pending_facts(accounts: DataFrame, fact: DataFrame | None, gate: str) -> DataFrame:
    """Savings accounts still to price, by the same two rules."""
    savings = M.savings_accounts(accounts)
    if fact is None:
        return savings
    if gate == "new_keys":
        return new_keys(savings, fact, savings["account_id"], "account_id")
    return since_watermark(savings, "modified_date", fact, "modified_date")


def merge_target(spark: SparkSession, cat: Catalog, layer: str, name: str, key: str, build, run_ts, sources: str,
                 full_refresh: bool = False) -> DataFrame:
    """Build one target's change set, store it, merge it and log the run; returns the change set.

    ``build(existing)`` gives the change set; ``existing`` is a ``Stored`` target, of which
    joins by key read the touched buckets only. A failure is logged with its error and
    raised again. The merge is based on the version that ``existing`` was read from.
    """
    started, table, log, ts = time.time(), cat.table(spark, layer, name), cat.process_log(spark), _ntz(run_ts)
    base = table.version()
    existing = None if full_refresh or base is None else table.stored(base)
    try:
        delta = materialize(build(existing), f"{name}_changes")  # computed once; counted and merged from storage
        stats = materialize(process_stats(existing, delta, key), "process_stats")
        if existing is None:
            table.overwrite(delta, key, base)
        else:
            table.upsert(delta, key, base=base)
    except Exception as exc:
        nothing = spark.range(1).selectExpr("0L as records_processed", "0L as records_inserted", "0L as records_updated")
        log.append(process_row(nothing, ts, sources, name, "failed", round(time.time() - started, 3), str(exc)))
        raise
    log.append(process_row(stats, ts, sources, name, "completed", round(time.time() - started, 3)))
    return delta


def run_all(spark: SparkSession, root: str, accounts_landing: str, customers_landing: str, run_ts,
            export_path: str | None = None, ingest_mode: str = "all_unseen", gate: str = "watermark",
            tariff: Tariff = DEFAULT_TARIFF, refresh_on: str = "accounts", strict_access: bool = True,
            full_refresh: bool = False) -> dict:
    """``full_refresh=True`` rebuilds structured and curated tables from the whole raw
    layer (as on a first run) instead of merging increments."""
    cat = Catalog(root)
    out: dict = {}
    for t in (cat.ledger(spark), *(cat.table(spark, *n) for n in MERGED)):
        t.expire(keep=4)

    # raw
    out["raw_accounts"] = ingest(spark, cat, ACCOUNTS, accounts_landing, run_ts, ingest_mode)
    out["raw_customers"] = ingest(spark, cat, CUSTOMERS, customers_landing, run_ts, ingest_mode)
    ready = pair_gate(cat.ledger(spark).read())
    out["pair_ready"] = bool(ready is not None and ready.first()["ready"])
    if not all(raw_exists(spark, cat.raw(n)) for n in ("raw_accounts", "raw_customers")):
        return out | {"structured": "waiting", "curated": "waiting"}  # one of the pair has never arrived
    log = cat.schema_log(spark).read()
    drifted = set() if log is None else {r[0] for r in log.groupBy("table_name").count()
                                         .filter("count > 1").select("table_name").collect()}
    raw_a = read_raw(spark, cat.raw("raw_accounts"), "raw_accounts" in drifted)
    raw_c = read_raw(spark, cat.raw("raw_customers"), "raw_customers" in drifted)

    # structured (skip gate, then incremental or full model)
    acc_t, cust_t = cat.table(spark, "structured", "str_accounts"), cat.table(spark, "structured", "str_customers")
    acc_e, cust_e = (None, None) if full_refresh else (acc_t.read(), cust_t.read())
    if full_refresh or any_pending(_pending(raw_a, acc_e, "AccountID", "account_id", gate)) or \
            any_pending(_pending(raw_c, cust_e, "CustomerID", "customer_id", gate)):
        merge_target(spark, cat, "structured", "str_accounts", "account_id", lambda e: M.str_accounts(raw_a, e, run_ts),
                     run_ts, "raw_accounts", full_refresh)
        merge_target(spark, cat, "structured", "str_customers", "customer_id",
                     lambda e: M.str_customers(raw_c, e, run_ts), run_ts, "raw_customers", full_refresh)
        out["structured"] = "processed"
    else:
        out["structured"] = "skipped"
    acc, cust = acc_t.read(), cust_t.read()
    tables = {"str_accounts": acc, "str_customers": cust}

    # curated
    fact_t = cat.table(spark, "curated", "fact_customer_balances")
    dim_a_t, dim_c_t = cat.table(spark, "curated", "dim_account"), cat.table(spark, "curated", "dim_customer")
    fact_e = None if full_refresh else fact_t.read()
    if fact_e is None or (out["structured"] == "processed" and gate != "new_keys") or \
            any_pending(_pending_facts(acc, fact_e, gate)):
        merge_target(spark, cat, "curated", "dim_account", "account_id",
                     lambda e: M.dim_account(M.modified_since(acc, e), e), run_ts, "str_accounts", full_refresh)
        merge_target(spark, cat, "curated", "dim_customer", "customer_id", lambda e: M.dim_customer(cust, e), run_ts,
                     "str_customers", full_refresh)
        merge_target(spark, cat, "curated", "fact_customer_balances", "account_id",
                     lambda e: M.fact_customer_balances(acc, cust, e, run_ts, tariff, refresh_on), run_ts,
                     "str_accounts,str_customers", full_refresh)
        out["curated"] = "processed"
    else:
        out["curated"] = "skipped"
    tables.update(dim_account=dim_a_t.read(), dim_customer=dim_c_t.read(), fact_customer_balances=fact_t.read())

    # access: always a full snapshot
    summary_t = cat.table(spark, "access", "account_summary")
    summary_t.overwrite(M.account_summary(tables["fact_customer_balances"], ordered=False))
    summary_t.expire()
    tables["account_summary"] = summary_t.read()

    checks = Q.structured_checks("warn") + Q.curated_checks("warn") + \
        Q.access_checks("error" if strict_access else "warn")
    checked = Q.run_checks(tables, checks).unionByName(Q.singular_checks(tables, "warn"))
    results = materialize(checked, "check_results")
    cat.check_results(spark).append(check_rows(results, _ntz(run_ts)))
    out["checks_failed"] = results.filter(~F.col("passed")).count()
    Q.enforce(results)

    report = present(tables["account_summary"])
    if export_path:
        out["rows_exported"] = export_csv(report, export_path, ["customer_id", "account_id"])
    out["statistics"] = summary_statistics(report).first().asDict()
    return out
