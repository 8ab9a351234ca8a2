"""Declarative data-quality checks over DataFrames.

Row-level checks of one table (not_null, expression) fold into ONE aggregate
pass; ``unique`` and ``accepted_values`` are grouped aggregates with map-side
partial aggregation; ``relationships`` is an anti-join. Results are one small
DataFrame: (table_name, check_name, column_name, failures, severity, passed).

Failure counts follow the usual data-test conventions:
  not_null          rows where the column is NULL
  unique            distinct non-NULL values occurring more than once
  accepted_values   distinct non-NULL values outside the list
  relationships     child rows with a non-NULL key absent from the parent
  expression        rows where ``<column> <expression>`` is false (NULL is not a failure)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RESULT_COLUMNS = ("table_name", "check_name", "column_name", "failures", "severity", "passed")


class DataQualityError(RuntimeError):
    """Raised when a check of severity ``error`` fails."""


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    column: str
    values: tuple = ()
    expression: str | None = None
    to_table: str | None = None
    to_column: str | None = None
    severity: str = "warn"

    @property
    def name(self) -> str:
        if self.kind == "expression":
            return f"expression_is_true({self.column} {self.expression})"
        if self.kind == "relationships":
            return f"relationships({self.column} -> {self.to_table}.{self.to_column})"
        if self.kind == "accepted_values":
            return "accepted_values(" + ",".join(map(str, self.values)) + ")"
        return f"{self.kind}({self.column})"


def not_null(table, column, severity="warn"):
    return Check(table, "not_null", column, severity=severity)


def unique(table, column, severity="warn"):
    return Check(table, "unique", column, severity=severity)


def accepted_values(table, column, values, severity="warn"):
    return Check(table, "accepted_values", column, values=tuple(values), severity=severity)


def relationships(table, column, to_table, to_column, severity="warn"):
    return Check(table, "relationships", column, to_table=to_table, to_column=to_column, severity=severity)


def expression_is_true(table, column, expression, severity="warn"):
    return Check(table, "expression", column, expression=expression, severity=severity)


def _row_level_fail(c: Check):
    if c.kind == "not_null":
        return F.col(c.column).isNull()
    if c.kind == "expression":
        return ~F.expr(f"{c.column} {c.expression}")
    raise ValueError(c.kind)


def _result(c: Check, failures) -> DataFrame:
    return failures.select(
        F.lit(c.table).alias("table_name"), F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"), F.lit(c.severity).alias("severity"),
    )


def _failures(checks: Sequence[Check]) -> list[Column]:
    return [F.count_if(_row_level_fail(c)).alias(f"c{i}") for i, c in enumerate(checks)]


def _row_results(wide: DataFrame, checks: Sequence[Check], failures: Sequence[Column]) -> DataFrame:
    """One row a check from one row of failure counts."""
    rows = F.array(*[
        F.struct(F.lit(c.table).alias("table_name"), F.lit(c.name).alias("check_name"),
                 F.lit(c.column).alias("column_name"), n.cast("bigint").alias("failures"),
                 F.lit(c.severity).alias("severity"))
        for c, n in zip(checks, failures)
    ])
    return wide.select(F.inline(rows))


def _row_level(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one table in a single aggregate, unpivoted to one row per check."""
    return _row_results(df.agg(*_failures(checks)), checks, [F.col(f"c{i}") for i in range(len(checks))])


class RowChecks:
    """The row-level checks of one table, counted by the job that writes it.

    ``on`` attaches the counts to the frame that is written, and nothing else may come
    between: they are then taken in the tasks that write, once a partition. ``results``
    waits for that job.
    """

    def __init__(self, table: str, checks: Sequence[Check]):
        self.table = table
        self.checks = [c for c in checks if c.table == table and c.kind in ("not_null", "expression")]
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *_failures(self.checks)) if self.checks else df

    def results(self, spark: SparkSession) -> DataFrame | None:
        if not self.checks:
            return None
        counts = self._seen.get
        return _row_results(spark.range(1), self.checks, [F.lit(counts[f"c{i}"]) for i in range(len(self.checks))])


def failing_rows(tables: Mapping[str, DataFrame], c: Check) -> DataFrame:
    """The offending rows / values of one check (what a data test returns)."""
    df = tables[c.table]
    col = F.col(c.column)
    if c.kind in ("not_null", "expression"):
        return df.filter(_row_level_fail(c))
    if c.kind == "unique":
        return (df.filter(col.isNotNull()).groupBy(col.alias("unique_field"))
                .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))
    if c.kind == "accepted_values":
        return (df.filter(col.isNotNull() & ~col.isin(*c.values)).groupBy(col.alias("value_field"))
                .agg(F.count(F.lit(1)).alias("n_records")))
    if c.kind == "relationships":
        parent = tables[c.to_table].select(F.col(c.to_column).alias("_to_field"))
        child = df.filter(col.isNotNull()).select(col.alias("from_field"))
        return child.join(parent, F.col("from_field") == F.col("_to_field"), "left_anti")
    raise ValueError(c.kind)


def _value_level(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame | None:
    """All ``unique`` and ``accepted_values`` checks in ONE grouped aggregate.

    Each table is scanned once and emits a (check index, value) pair per row and
    check; one shuffle groups all pairs (with map-side partial counts), and a second,
    tiny aggregate turns value counts into failures per check.
    """
    by_table: dict[str, list[tuple[int, Check]]] = {}
    for i, c in enumerate(checks):
        by_table.setdefault(c.table, []).append((i, c))
    parts = []
    for table, ics in by_table.items():
        pairs = []
        for i, c in ics:
            v = F.col(c.column)
            keep = v.isNotNull() if c.kind == "unique" else (v.isNotNull() & ~v.isin(*c.values))
            pairs.append(F.when(keep, F.struct(F.lit(i).alias("i"), v.cast("string").alias("v"))))
        parts.append(tables[table].select(F.explode(F.filter(F.array(*pairs), lambda x: x.isNotNull())).alias("p"))
                     .select("p.i", "p.v"))
    if not parts:
        return None
    pairs = reduce(lambda a, b: a.unionByName(b), parts)
    counted = pairs.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    unique_ids = [i for i, c in enumerate(checks) if c.kind == "unique"]
    failing = F.when(F.col("i").isin(*unique_ids), F.col("n") > 1).otherwise(F.lit(True)) if unique_ids \
        else F.lit(True)
    per_check = counted.groupBy("i").agg(F.count_if(failing).alias("failures"))
    meta = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c.table).alias("table_name"),
                              F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                              F.lit(c.severity).alias("severity")) for i, c in enumerate(checks)])
    # Every check gets a row, failures 0 when no value failed (outer side is one row per check).
    all_checks = per_check.sparkSession.range(1).select(F.inline(meta))
    return all_checks.join(per_check, "i", "left").select(
        "table_name", "check_name", "column_name",
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"), "severity")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], counted: Sequence[RowChecks] = ()) -> DataFrame:
    """Run checks: one aggregate pass per table for row-level checks, one grouped
    aggregate for all value-level checks, one anti-join per relationship. Row-level
    checks that were ``counted`` when their table was written cost no pass."""
    known = {c for w in counted for c in w.checks}
    parts: list[DataFrame] = []
    spark = next((tables[c.table].sparkSession for c in checks), None)
    parts += [r for w in counted if (r := w.results(spark)) is not None]
    checks = [c for c in checks if c not in known]
    row_level: dict[str, list[Check]] = {}
    value_level: list[Check] = []
    for c in checks:
        if c.kind in ("not_null", "expression"):
            row_level.setdefault(c.table, []).append(c)
        elif c.kind in ("unique", "accepted_values"):
            value_level.append(c)
        else:
            parts.append(_result(c, failing_rows(tables, c).agg(F.count(F.lit(1)).alias("failures"))))
    for table, cs in row_level.items():
        parts.append(_row_level(tables[table], table, cs))
    v = _value_level(tables, value_level)
    if v is not None:
        parts.append(v)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("passed", F.col("failures") == 0)


def enforce(results: DataFrame) -> DataFrame:
    """Raise if any ``error``-severity check failed; ``warn`` failures are reported only."""
    bad = results.filter((F.col("severity") == "error") & ~F.col("passed")).collect()
    if bad:
        names = ", ".join(f"{r.table_name}.{r.check_name}={r.failures}" for r in bad)
        raise DataQualityError(f"data-quality checks failed: {names}")
    return results


# The reference's declared data tests per layer.
ACCOUNT_TYPES = ("savings", "checking", "money_market")
QUALITY_FLAGS = ("VALID", "IMPUTED_NULL_BALANCE")


def structured_checks(severity: str = "warn") -> list[Check]:
    s = severity
    return [
        unique("str_accounts", "account_id", s), not_null("str_accounts", "account_id", s),
        not_null("str_accounts", "account_type", s), accepted_values("str_accounts", "account_type", ACCOUNT_TYPES, s),
        not_null("str_accounts", "original_balance", s), expression_is_true("str_accounts", "original_balance", ">= 0", s),
        not_null("str_accounts", "customer_id", s),
        relationships("str_accounts", "customer_id", "str_customers", "customer_id", s),
        not_null("str_accounts", "data_quality_flag", s),
        accepted_values("str_accounts", "data_quality_flag", QUALITY_FLAGS, s),
        unique("str_customers", "customer_id", s), not_null("str_customers", "customer_id", s),
        not_null("str_customers", "customer_name", s), not_null("str_customers", "hasloan", s),
    ]


def curated_checks(severity: str = "warn") -> list[Check]:
    s = severity
    return [
        unique("dim_customer", "customer_id", s), not_null("dim_customer", "customer_id", s),
        not_null("dim_customer", "customer_name", s), not_null("dim_customer", "hasloan", s),
        unique("dim_account", "account_id", s), not_null("dim_account", "account_id", s),
        not_null("dim_account", "account_type", s), not_null("dim_account", "original_balance", s),
        not_null("dim_account", "customer_id", s),
        relationships("dim_account", "customer_id", "str_customers", "customer_id", s),
        unique("fact_customer_balances", "account_id", s), not_null("fact_customer_balances", "account_id", s),
        not_null("fact_customer_balances", "customer_id", s), not_null("fact_customer_balances", "account_type", s),
        accepted_values("fact_customer_balances", "account_type", ("savings",), s),
        not_null("fact_customer_balances", "original_balance", s),
        expression_is_true("fact_customer_balances", "original_balance", ">= 0", s),
        not_null("fact_customer_balances", "interest_rate", s),
        expression_is_true("fact_customer_balances", "interest_rate", "> 0", s),
        expression_is_true("fact_customer_balances", "interest_rate", "<= 0.025", s),
        not_null("fact_customer_balances", "annual_interest", s),
        expression_is_true("fact_customer_balances", "annual_interest", ">= 0", s),
        not_null("fact_customer_balances", "new_balance", s),
        expression_is_true("fact_customer_balances", "new_balance", "= original_balance + annual_interest", s),
    ]


def access_checks(severity: str = "error") -> list[Check]:
    s = severity
    return [
        not_null("account_summary", "customer_id", s),
        unique("account_summary", "account_id", s), not_null("account_summary", "account_id", s),
        not_null("account_summary", "original_balance", s),
        expression_is_true("account_summary", "original_balance", ">= 0", s),
        not_null("account_summary", "interest_rate", s),
        expression_is_true("account_summary", "interest_rate", ">= 0.01", s),
        expression_is_true("account_summary", "interest_rate", "<= 0.025", s),
        not_null("account_summary", "annual_interest", s),
        expression_is_true("account_summary", "annual_interest", ">= 0", s),
        not_null("account_summary", "new_balance", s),
        expression_is_true("account_summary", "new_balance", ">= original_balance", s),
    ]


def interest_mismatches(fact: DataFrame) -> DataFrame:
    """Fact rows whose stored interest or new balance disagrees with a recomputation."""
    exp_interest = F.round(F.col("original_balance") * F.col("interest_rate"), 2)
    return fact.filter(
        (F.round("annual_interest", 2) != exp_interest)
        | (F.round("new_balance", 2) != F.round(F.col("original_balance") + F.col("annual_interest"), 2))
    ).select("account_id", "original_balance", "interest_rate", "annual_interest", "new_balance",
             exp_interest.alias("expected_annual_interest"),
             F.round(F.col("original_balance") + exp_interest, 2).alias("expected_new_balance"))


def orphan_accounts(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts whose customer is unknown; the fact drops them, so they are reported."""
    return accounts.join(customers.select("customer_id"), "customer_id", "left_anti").select("account_id", "customer_id")


def singular_checks(tables: Mapping[str, DataFrame], severity: str = "warn") -> DataFrame:
    """The three rule checks over whole tables, in the result columns of ``run_checks``."""
    fact = tables["fact_customer_balances"]
    found = (("fact_customer_balances", "interest_calculation", "annual_interest", interest_mismatches(fact)),
             ("fact_customer_balances", "only_savings", "account_type", non_savings_in_fact(fact)),
             ("str_accounts", "orphan_accounts", "customer_id", orphan_accounts(tables["str_accounts"], tables["str_customers"])))
    parts = [rows.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(t).alias("table_name"), F.lit(n).alias("check_name"), F.lit(c).alias("column_name"), "failures",
        F.lit(severity).alias("severity"), (F.col("failures") == 0).alias("passed")) for t, n, c, rows in found]
    return reduce(lambda a, b: a.unionByName(b), parts)


def non_savings_in_fact(fact: DataFrame) -> DataFrame:
    return fact.filter(F.lower("account_type") != "savings").select("account_id", "account_type")
