"""Registered queries: data-quality suite (J1–J11)."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import functions as F

from vaultline.operators import quality as Q
from vaultline.plans import models as M
from vaultline.plans import oracle as O
from vaultline.plans.present import present
from vaultline.plans.registry import curated_full, query
from vaultline.session import at_once, materialize, work_dir
from vaultline.sinks.ledgers import check_rows
from vaultline.sinks.tables import VersionedTable
from vaultline.sources import testdata as T
from vaultline.tariff import Tariff

# A tariff change that breaks the declared rate cap (tier 3 at 3 %): the suite must catch it.
RAISED = Tariff(tier_3_rate=Decimal("0.03"))


class LayerTables(Mapping):
    """The layer tables as a run commits them, each built when a check first names it and
    written once; later layers are built from the stored ones.

    With ``checks``, the dimensions and the report are written too, and the job that
    writes a table counts its row checks (``counted``)."""

    _BUILD = {
        "raw_accounts": lambda t: T.raw_accounts(t.spark, t.sf),
        "raw_customers": lambda t: T.raw_customers(t.spark, t.sf),
        "clean_accounts": lambda t: M.clean_accounts(t["raw_accounts"]),
        "str_accounts": lambda t: M.str_accounts(t["raw_accounts"], None, O.RUN_1),
        "str_customers": lambda t: M.str_customers(t["raw_customers"], None, O.RUN_1),
        "dim_account": lambda t: M.dim_account(t["str_accounts"]),
        "dim_customer": lambda t: M.dim_customer(t["str_customers"]),
        "fact_customer_balances": lambda t: M.fact_customer_balances(t["str_accounts"], t["str_customers"], None, O.RUN_1),
        "fact_repriced": lambda t: M.fact_customer_balances(t["str_accounts"], t["str_customers"], None, O.RUN_1, RAISED),
        "account_summary": lambda t: M.account_summary(t["fact_customer_balances"], ordered=False),
    }

    _LATER = ("fact_customer_balances", "fact_repriced", "account_summary")
    _STORED = ("str_accounts", "str_customers", "fact_customer_balances")
    _COMMITTED = (*_STORED, "dim_account", "dim_customer", "account_summary")

    def __init__(self, spark, sf, checks=()):
        self.spark, self.sf, self._built, self._checks, self.counted = spark, sf, {}, checks, []

    def __getitem__(self, name):
        if name not in self._built:
            if name in self._LATER and "str_accounts" not in self._built:
                at_once(lambda: self["str_accounts"], lambda: self["str_customers"])  # independent chains
            built = self._BUILD[name](self)
            if name in (self._COMMITTED if self._checks else self._STORED):
                counts = Q.RowChecks(name, self._checks)
                built = materialize(counts.on(built), name)
                self.counted.append(counts)
            self._built[name] = built
        return self._built[name]

    def commit(self):
        """Write all tables of the layers, those of one layer side by side."""
        at_once(lambda: self["str_accounts"], lambda: self["str_customers"])
        at_once(*[lambda n=n: self[n] for n in ("dim_account", "dim_customer", "fact_customer_balances")])
        self["account_summary"]
        return self

    def __iter__(self):
        return iter(self._BUILD)

    def __len__(self):
        return len(self._BUILD)


layer_tables = LayerTables


LAYER_CTES = O.FULL + [
    ("clean_accounts", O.clean_accounts_sql("raw_accounts")),
    ("dim_account", "select account_id, account_type, original_balance, customer_id, created_date, modified_date, "
                    "metadata_json from str_accounts"),
    ("dim_customer", "select customer_id, customer_name, hasloan, created_date, modified_date, metadata_json "
                     "from str_customers"),
    ("fact_customer_balances", "select * from fact"),
    ("fact_repriced", O.fact_sql("str_accounts", "str_customers", None, O.RUN_1, tier_3="0.03")),
    ("account_summary", "select * from fact where lower(account_type) = 'savings'"),
]


def _sql_str(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def check_sql(c: Q.Check) -> str:
    """DuckDB text of one check's failure count, written from the check conventions."""
    col = c.column
    if c.kind == "not_null":
        body = f"select count(*) as n from {c.table} where {col} is null"
    elif c.kind == "expression":
        body = f"select count(*) as n from {c.table} where not ({col} {c.expression})"
    elif c.kind == "unique":
        body = (f"select count(*) as n from (select {col} from {c.table} where {col} is not null "
                f"group by {col} having count(*) > 1) d")
    elif c.kind == "accepted_values":
        vals = ", ".join(_sql_str(v) for v in c.values)
        body = f"select count(distinct {col}) as n from {c.table} where {col} not in ({vals})"
    elif c.kind == "relationships":
        body = (f"select count(*) as n from {c.table} ch left join {c.to_table} p on ch.{col} = p.{c.to_column} "
                f"where ch.{col} is not null and p.{c.to_column} is null")
    else:
        raise ValueError(c.kind)
    return (f"select {_sql_str(c.table)} as table_name, {_sql_str(c.name)} as check_name, "
            f"{_sql_str(c.column)} as column_name, cast(n as bigint) as failures, {_sql_str(c.severity)} as severity, "
            f"n = 0 as passed from ({body}) x")


def suite_sql(checks) -> str:
    return O.over(LAYER_CTES, "\nunion all\n".join(check_sql(c) for c in checks))


ALL_SUITES = Q.structured_checks() + Q.curated_checks() + Q.access_checks()
RAW_CHECKS = [
    Q.not_null("raw_accounts", "Balance"), Q.not_null("raw_customers", "HasLoan"),
    Q.unique("raw_accounts", "AccountID"), Q.unique("clean_accounts", "account_id"),
    Q.accepted_values("raw_accounts", "AccountType", Q.ACCOUNT_TYPES),
    Q.relationships("raw_accounts", "CustomerID", "str_customers", "customer_id"),
    Q.expression_is_true("fact_repriced", "interest_rate", "<= 0.025"),
    Q.expression_is_true("fact_repriced", "new_balance", "= original_balance + annual_interest"),
]


def _kind(*kinds):
    return [c for c in ALL_SUITES + RAW_CHECKS if c.kind in kinds]


def _suite_query(name, checks):
    @query(name, suite_sql(checks))
    def q(spark, sf):
        return Q.run_checks(layer_tables(spark, sf), checks)
    return q


q_dq_not_null = _suite_query("dq_not_null", _kind("not_null"))
q_dq_unique = _suite_query("dq_unique", _kind("unique"))
q_dq_accepted_values = _suite_query("dq_accepted_values", _kind("accepted_values"))
q_dq_relationships = _suite_query("dq_relationships", _kind("relationships"))
q_dq_expression = _suite_query("dq_expression", _kind("expression"))


@query("dq_report", suite_sql(ALL_SUITES))
def q_dq_report(spark, sf):
    """All suites over the tables of a run; the jobs that write the tables count the row checks."""
    tables = LayerTables(spark, sf, ALL_SUITES).commit()
    return Q.run_checks(tables, ALL_SUITES, tables.counted)


# The rule: interest is balance times rate, to the cent; the new balance is their sum.
def interest_rule_sql(fact: str) -> str:
    return f"""
select {", ".join(f"cast({c} as double) as {c}" for c in ("original_balance", "interest_rate", "annual_interest", "new_balance"))},
       account_id, cast(due as double) as expected_annual_interest, cast(original_balance + due as double) as expected_new_balance
from (select *, cast(round(original_balance * interest_rate, 2) as decimal(15,2)) as due from {fact}) f
where annual_interest - due <> 0 or new_balance - original_balance - annual_interest <> 0"""


# Seeded violations, the same in both engines: every fact of an account that ends in 7
# has a cent too much interest, one that ends in 3 is not a savings account.
SEEDED_FACT = """
select * replace (case when account_id like '%7' then cast(annual_interest + 0.01 as decimal(15,2)) else annual_interest end as annual_interest,
                  case when account_id like '%3' then 'checking' else account_type end as account_type)
from fact_customer_balances"""
SEEDED_CTES = LAYER_CTES + [("fact_seeded", SEEDED_FACT)]


def seeded_fact(spark, sf):
    fact = curated_full(spark, sf)[2]
    more = (F.col("annual_interest") + F.lit(Decimal("0.01"))).cast("decimal(15,2)")
    return fact.withColumn("annual_interest", F.when(F.col("account_id").endswith("7"), more).otherwise(F.col("annual_interest"))) \
        .withColumn("account_type", F.when(F.col("account_id").endswith("3"), F.lit("checking")).otherwise(F.col("account_type")))


@query("dq_interest_accuracy", O.over(LAYER_CTES, interest_rule_sql("fact_customer_balances")))
def q_dq_interest_accuracy(spark, sf):
    return present(Q.interest_mismatches(curated_full(spark, sf)[2]))


@query("dq_interest_accuracy_seeded", O.over(SEEDED_CTES, interest_rule_sql("fact_seeded")))
def q_dq_interest_accuracy_seeded(spark, sf):
    return present(Q.interest_mismatches(seeded_fact(spark, sf)))


@query("dq_only_savings", O.over(LAYER_CTES, "select account_id, account_type from fact_customer_balances "
                                             "where lower(account_type) <> 'savings'"))
def q_dq_only_savings(spark, sf):
    return Q.non_savings_in_fact(curated_full(spark, sf)[2])


@query("dq_only_savings_seeded", O.over(SEEDED_CTES, "select account_id, account_type from fact_seeded "
                                                     "where account_type not in ('savings')"))
def q_dq_only_savings_seeded(spark, sf):
    return Q.non_savings_in_fact(seeded_fact(spark, sf))


def _singular_sql(table: str, check: str, column: str, body: str) -> str:
    return (f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, "
            f"cast(count(*) as bigint) as failures, 'warn' as severity, count(*) = 0 as passed from ({body}) x")


_STORED = " union all ".join([
    *(check_sql(c) for c in Q.structured_checks()),
    _singular_sql("fact_customer_balances", "interest_calculation", "annual_interest", interest_rule_sql("fact_seeded")),
    _singular_sql("fact_customer_balances", "only_savings", "account_type",
                  "select 1 from fact_seeded where account_type not in ('savings')"),
    _singular_sql("str_accounts", "orphan_accounts", "customer_id",
                  "select 1 from str_accounts a where not exists (select 1 from str_customers c where c.customer_id = a.customer_id)")])


@query("dq_results_log", O.over(SEEDED_CTES, f"""
select {O.lit_ts(O.RUN_1)} as run_timestamp, r.* from ({_STORED}) r
union all
select {O.lit_ts(O.RUN_2)}, r.* from ({_STORED}) r"""))
def q_dq_results_log(spark, sf):
    """Two runs' check results (declared checks, then the rule checks on a seeded fact) appended to the results table."""
    t = layer_tables(spark, sf)
    tables = {"str_accounts": t["str_accounts"], "str_customers": t["str_customers"], "fact_customer_balances": seeded_fact(spark, sf)}
    results = materialize(Q.run_checks(tables, Q.structured_checks()).unionByName(Q.singular_checks(tables)), "check_results")
    log = VersionedTable(spark, work_dir(spark, "check_results"))
    for run in (O.RUN_1, O.RUN_2):
        log.append(check_rows(results, F.lit(run).cast("timestamp_ntz")))
    return log.read()


@query("dq_failing_values", O.over(LAYER_CTES, """
select AccountType as value_field, count(*) as n_records from raw_accounts
where AccountType not in ('savings', 'checking', 'money_market') group by AccountType"""))
def q_dq_failing_values(spark, sf):
    """The offending values behind one failed check (what the data test itself returns)."""
    tables = {"raw_accounts": T.raw_accounts(spark, sf)}
    return Q.failing_rows(tables, Q.accepted_values("raw_accounts", "AccountType", Q.ACCOUNT_TYPES)) \
        .select("value_field", F.col("n_records"))
