"""Scale guards on the physical plans of the registered queries."""

import pytest

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
# queries whose construction writes landing files / runs streams are checked separately (slow)
SKIP = {"csv_scan", "lineage_columns", "file_fingerprint", "latest_file", "unprocessed_files", "raw_append",
        "file_ledger_upsert", "ledger_report", "schema_version_log", "latest_schema_version", "schema_drift",
        "stream_ingest", "stream_upsert", "csv_export_roundtrip", "csv_scan_mixed_headers", "csv_scan_quoted", "ingest_retry",
        "schema_report", "process_log", "stream_replay", "stream_str_accounts", "stream_str_customers", "pair_gate",
        "stream_restart", "stream_strict_upsert", "stream_late_rows", "ingest_quarantine", "pair_cursor", "csv_scan_quoted_splits",
        "raw_reload", "whole_run"}


def _plan(df, aqe_off=True):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    if aqe_off:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # the text .explain("formatted") prints (no truncated fields)
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def _names():
    import __spark_entry__ as E
    # training-data operators run Python on purpose; their own tests look at their plans
    return sorted(n for n in E.queries() if n not in SKIP and not n.startswith("op") and n != "pipeline")


@pytest.fixture()
def written(monkeypatch):
    """Plans of everything written as Parquet while a query is built (stored intermediate steps, tables)."""
    from pyspark.sql.readwriter import DataFrameWriter
    plans, write = [], DataFrameWriter.parquet

    def record(self, *args, **kw):
        plans.append(_plan(self._df, aqe_off=False))
        return write(self, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", record)
    return plans


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_or_python_in_plan(spark, name, written):
    import __spark_entry__ as E
    plans = [_plan(E.queries()[name](spark, SF_SMALL), aqe_off=False), *written]
    bad = [op for op in FORBIDDEN for plan in plans if op in plan]
    assert not bad, f"{name}: {bad}"


def test_ingestion_and_streaming_steps_have_sound_plans(spark, written):
    """The steps of the queries that land files first; file examination is the one Python step."""
    import __spark_entry__ as E
    for name in ("ingest_retry", "stream_str_accounts", "process_log"):
        E.queries()[name](spark, SF_SMALL)
    assert len(written) > 10
    assert not [op for op in FORBIDDEN for plan in written if op in plan]


def test_watermark_and_columns_reach_the_scan(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["watermark_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_dedupe_limits_map_side_before_the_shuffle(spark):
    import re

    import __spark_entry__ as E
    plan = _plan(E.queries()["dedupe_latest_accounts"](spark, SF_SMALL))
    nodes = re.findall(r"\n\((\d+)\) (\w+)[^\n]*\n(?:[^\n]+\n)*?Arguments: ([^\n]*)", plan)
    limits = {kind: int(n) for n, op, args in nodes if op == "WindowGroupLimit"
              for kind in ("Partial", "Final") if args.endswith(kind)}
    exchanges = [int(n) for n, op, args in nodes if op == "Exchange" and "hashpartitioning(account_id" in args]
    # formatted explain numbers children first: partial limit < exchange < final limit
    assert limits["Partial"] < exchanges[0] < limits["Final"], (limits, exchanges)


def test_merge_leaves_a_large_target_unshuffled(spark):
    """A stored change set under the threshold is broadcast; the target passes an anti-join and a semi-join."""
    from vaultline.operators.incremental import preserve_created, upsert
    from vaultline.session import materialize
    target = materialize(spark.range(300_000).selectExpr("cast(id as string) as k", "id as v", "timestamp_ntz'2024-01-01' as created_date"), "target")
    delta = materialize(spark.range(50).selectExpr("cast(id * 7000 as string) as k", "-id as v"), "delta")
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "100k")
    try:
        stamped = preserve_created(delta, target, "k", "2025-01-01 00:00:00")
        plan = _plan(stamped)
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan
        assert "Exchange hashpartitioning" not in _plan(upsert(target, materialize(stamped, "delta2"), "k"))
    finally:
        spark.conf.set(key, old)


def test_incremental_models_deduplicate_once(spark):
    from vaultline.plans.registry import two_runs
    r = two_runs(spark, SF_SMALL)
    from vaultline.plans import models as M
    from vaultline.plans import oracle as O
    from vaultline.sources import testdata as T
    plan = _plan(M.str_accounts(T.raw_accounts(spark, SF_SMALL), r["acc1"], O.RUN_2))
    assert "Window" not in plan  # the change set is read back, not deduplicated again


def test_flagship_reads_only_needed_columns(spark):
    import __spark_entry__ as E
    plan = _plan(E.entry(spark))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double," \
           "o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan  # names are not needed by the report
    assert "o_orderpriority" not in plan and "c_name" not in plan and "c_acctbal" not in plan


def test_incremental_run_prunes_raw_partitions(spark, tmp):
    from vaultline.plans import models as M
    from vaultline.sinks.tables import append_raw, read_raw
    from vaultline.sources import testdata as T
    append_raw(T.raw_accounts(spark, SF_SMALL), f"{tmp}/raw")
    raw = read_raw(spark, f"{tmp}/raw", merge_schema=False)
    first = M.str_accounts(raw.filter("_ingested_at < '1997-01-01'"), None, "2025-01-01 00:00:00")
    from vaultline.operators.incremental import since_watermark
    plan = _plan(since_watermark(raw, "_ingested_at", first, "_last_processed_at"))
    assert "PartitionFilters: [isnotnull(_ingest_date" in plan and "(_ingest_date" in plan and ">= 1996-" in plan


def test_the_second_dimension_run_reads_stored_accounts(spark):
    """The merge of run 2 is a step of its own: only the joins with the dimension are left in the last one."""
    import __spark_entry__ as E
    df = E.queries()["dim_account_incremental"](spark, SF_SMALL)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
