"""Registered queries: streaming ingestion / upsert, export, lineage, audit history."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.functions.audit import append_history, history_entry
from vaultline.plans import models as M
from vaultline.plans import oracle as O
from vaultline.plans.present import present
from vaultline.plans.gates import pair_triggers
from vaultline.plans.ingest import ACCOUNTS, Catalog
from vaultline.plans.registry import curated_full, query, structured_full, two_runs
from vaultline.plans.registry_ingest import CLEAN_LOAD, _LostLedger, _raw_rows
from vaultline.session import work_dir
from vaultline.sinks.export import export_csv
from vaultline.sinks.tables import VersionedTable, _FS
from vaultline.sources import landing as L
from vaultline.sources import landing_fixtures as LF
from vaultline.sources import testdata as T
from vaultline.streaming.jobs import ACCOUNTS as ACCOUNT_STREAM
from vaultline.streaming.jobs import CUSTOMERS as CUSTOMER_STREAM
from vaultline.streaming.jobs import ingest_batch, ingest_stream, stream_structured, watch_pairs


def _stream_catalog(spark, sf):
    """Account files picked up by a file stream, 40 to a micro-batch."""
    landing, cat = work_dir(spark, "landing"), Catalog(work_dir(spark, "catalog"))
    LF.write_csv(LF.account_source_rows(spark, sf), landing)
    ingest_stream(spark, cat, ACCOUNTS, landing, work_dir(spark, "stream-ckpt"), max_files_per_trigger=40,
                  run_ts_of_batch=lambda b: O.RUN_1).awaitTermination()
    return cat, landing


@query("stream_ingest", CLEAN_LOAD)
def q_stream_ingest(spark, sf):
    return _raw_rows(spark, _stream_catalog(spark, sf)[0])


# Deliveries of both sources, by phase: the account files of some years and the customer files of some
# nations. A file's time follows from its month or nation, so phase 2 brings only older files.
PHASES = ((("1997",), ()), ((), range(10)), (("1995", "1996"), ()), (("1998",), range(10, 15)), ((), range(15, 25)),
          ("rest", ()))
_PHASE_A = "case " + " ".join(f"when year = '{y}' then {k}" for k, (ys, _) in enumerate(PHASES) if ys != "rest" for y in ys) \
    + f" else {len(PHASES) - 1} end"
_PHASE_C = "case " + " ".join(f"when nation in ({', '.join(map(str, ns))}) then {k}" for k, (_, ns) in enumerate(PHASES) if ns) + " end"
DELIVERIES = ("deliveries", f"""
select {_PHASE_A} as poll, 'accounts' as file_type, timestamp '2020-01-01' + to_days(30 * (cast(year as integer) - 1995) * 12 + 30 * month) as modified
from (select strftime(o_orderdate, '%Y') as year, cast(month(o_orderdate) as integer) as month from orders group by all)
union all
select {_PHASE_C}, 'customers', timestamp '2020-01-01' + to_days(40 * nation) from (select distinct cast(c_nationkey as integer) as nation from customer)""")
TRIGGERS = ("polls", """
select poll, max(max(modified) filter (where file_type = 'accounts')) over (order by poll) as accounts_modified,
       max(max(modified) filter (where file_type = 'customers')) over (order by poll) as customers_modified from deliveries group by poll""")
_FIRES = """accounts_modified is not null and customers_modified is not null and
    (accounts_modified, customers_modified) is distinct from (lag(accounts_modified) over (order by poll), lag(customers_modified) over (order by poll))"""


def _set_times(spark, path, at):
    """Give every file below the time that ``at`` reads from its path (days after the first)."""
    day, first = 86_400_000, 1_577_836_800_000
    for r in L.list_landing(spark, path).select("path", at.alias("days")).collect():
        files = _FS(spark, r.path)
        files.fs.setTimes(files.root, first + r.days * day, -1)


def _deliver(spark, sf, root, phase):
    years, nations = PHASES[phase]
    number = lambda pattern: F.regexp_extract("path", pattern, 1).cast("int")
    if years:
        year = F.substring("month", 1, 4)
        named = [y for ys, _ in PHASES if ys != "rest" for y in ys]
        rows = LF.account_source_rows(spark, sf).where(~year.isin(*named) if years == "rest" else year.isin(*years))
        LF.write_csv(rows, f"{root}/accounts", mode="append")
        _set_times(spark, f"{root}/accounts", (number(r"month=(\d+)") - 1995) * 360 + 30 * number(r"month=\d+-(\d+)"))
    if nations:
        rows = LF.customer_source_rows(spark, sf).where(F.col("nation").isin(*map(str, nations)))
        LF.write_csv(rows, f"{root}/customers", part="nation", mode="append")
        _set_times(spark, f"{root}/customers", 40 * number(r"nation=(\d+)"))


@query("pair_cursor", O.over([DELIVERIES, TRIGGERS], f"""
select poll, accounts_modified, customers_modified, 'done' as status, count(*) over () as calls
from (select *, {_FIRES} as fires from polls) p where fires"""))
def q_pair_cursor(spark, sf):
    """Six deliveries, a poll each; the pair log after each poll was drained twice: four pairs, each fired once."""
    root, cat, checkpoint, fired = work_dir(spark, "landing"), Catalog(work_dir(spark, "catalog")), work_dir(spark, "pair-ckpt"), []
    for d in ("accounts", "customers"):
        files = _FS(spark, f"{root}/{d}")
        files.fs.mkdirs(files.root)
    for phase in range(len(PHASES)):
        _deliver(spark, sf, root, phase)
        for _ in range(2):
            watch_pairs(spark, cat, f"{root}/accounts", f"{root}/customers", checkpoint, fired.append).awaitTermination()
    return cat.pair_log(spark).read().select(F.col("batch").alias("poll"), "accounts_modified", "customers_modified", "status",
                                             F.lit(len(fired)).cast("bigint").alias("calls"))


@query("pair_triggers", O.over([DELIVERIES, TRIGGERS], f"select poll, accounts_modified, customers_modified, {_FIRES} as fires from polls"))
def q_pair_triggers(spark, sf):
    """The same deliveries as a table of arrivals: which poll fires."""
    year, month = F.date_format("o_orderdate", "yyyy"), F.month("o_orderdate")
    months = T.read_table(spark, sf, "orders").select(year.alias("year"), month.alias("month")).distinct()
    nations = T.read_table(spark, sf, "customer").select(F.col("c_nationkey").cast("int").alias("nation")).distinct()
    at = lambda days: F.expr(f"timestamp_ntz'2020-01-01' + make_dt_interval({days})")
    arrivals = months.select(F.expr(_PHASE_A).cast("bigint").alias("poll"), F.lit("accounts").alias("file_type"),
                             at("360 * (cast(year as int) - 1995) + 30 * month").alias("modified")).unionByName(
        nations.select(F.expr(_PHASE_C).cast("bigint").alias("poll"), F.lit("customers").alias("file_type"), at("40 * nation").alias("modified")))
    return pair_triggers(arrivals)


@query("stream_replay", CLEAN_LOAD)
def q_stream_replay(spark, sf):
    """A micro-batch that wrote its rows and died is offered again, then once more after it completed."""
    landing, root = work_dir(spark, "landing"), work_dir(spark, "catalog")
    LF.write_csv(LF.account_source_rows(spark, sf), landing)
    arrived = L.list_landing(spark, landing)
    ingest_batch(spark, _LostLedger(root), ACCOUNTS, arrived, O.RUN_1)
    for run in (O.RUN_1, O.RUN_2):
        ingest_batch(spark, Catalog(root), ACCOUNTS, arrived, run)
    return _raw_rows(spark, Catalog(root))


# Rows of a streamed file, and files of a micro-batch: several micro-batches, more the more rows there are.
STREAM_ROWS, STREAM_FILES = 20_000, 2


def _stream(spark, model, raw_path, table, schema, checkpoint=None):
    stream_structured(spark, model, raw_path, table, checkpoint or work_dir(spark, "stream-ckpt"), schema,
                      max_files_per_trigger=STREAM_FILES, run_ts_of_batch=lambda b: O.RUN_1).awaitTermination()


def _streamed(spark, model, raw):
    """Raw rows streamed through a structured model, a few files to a micro-batch."""
    raw_path, table = work_dir(spark, "raw"), work_dir(spark, "streamed")
    raw.write.option("maxRecordsPerFile", STREAM_ROWS).parquet(raw_path)
    _stream(spark, model, raw_path, table, raw.schema)
    return VersionedTable(spark, table).read()


STREAMED_ACCOUNTS = O.over(O.FULL, f"select * {O.money('original_balance')} from str_accounts")


@query("stream_str_accounts", STREAMED_ACCOUNTS)
def q_stream_str_accounts(spark, sf):
    """Streamed accounts equal the batch model's table column for column."""
    return present(_streamed(spark, ACCOUNT_STREAM, T.raw_accounts(spark, sf)))


@query("stream_restart", STREAMED_ACCOUNTS)
def q_stream_restart(spark, sf):
    """Two streams write one table; the first loses its checkpoint after half of its rows and starts again at batch 0.

    Its first new batches carry numbers that the table has seen from the lost
    checkpoint, so only writers known by name, not by number, keep the later rows.
    """
    raw, table = T.raw_accounts(spark, sf), work_dir(spark, "streamed")
    mine, other = work_dir(spark, "raw"), work_dir(spark, "raw")
    part = F.pmod(F.xxhash64("AccountID", "_row_number"), F.lit(4))
    for k, (path, mode) in enumerate([(mine, "overwrite"), (other, "overwrite")]):
        raw.where(part == k).write.mode(mode).option("maxRecordsPerFile", STREAM_ROWS).parquet(path)
        _stream(spark, ACCOUNT_STREAM, path, table, raw.schema)
    raw.where(part > 1).write.mode("append").option("maxRecordsPerFile", STREAM_ROWS).parquet(mine)
    _stream(spark, ACCOUNT_STREAM, mine, table, raw.schema)  # a new checkpoint: every file again, batch ids from 0
    return present(VersionedTable(spark, table).read())


def _strict_stream(spark, sf):
    """Two deliveries as two micro-batches under the strict rule: (table, late rows)."""
    raw_path, table, late, checkpoint = (work_dir(spark, n) for n in ("raw", "streamed", "late", "stream-ckpt"))
    for delivery in T.account_deliveries(spark, sf):
        delivery.write.mode("append").parquet(raw_path)
        stream_structured(spark, ACCOUNT_STREAM, raw_path, table, checkpoint, delivery.schema, max_files_per_trigger=1_000_000,
                          run_ts_of_batch=lambda b: (O.RUN_1, O.RUN_2)[b], late_path=late).awaitTermination()
    return VersionedTable(spark, table).read(), VersionedTable(spark, late).read()


@query("stream_strict_upsert", O.over(O.TWO_RUNS, f"select * {O.money('original_balance')} from str_accounts_r2"))
def q_stream_strict_upsert(spark, sf):
    """Under the strict rule a stream of two deliveries equals two batch runs: the late checking file is ignored."""
    return present(_strict_stream(spark, sf)[0])


@query("stream_late_rows", O.over(O.TWO_RUNS, """
select AccountID, _row_number, _ingested_at, (select max(_last_processed_at) from str_accounts_r1) as _late_after from raw_accounts r
where _ingested_at <= (select max(_last_processed_at) from str_accounts_r1)
  and not exists (select 1 from raw_accounts_1 f where f._row_number = r._row_number)"""))
def q_stream_late_rows(spark, sf):
    """The rows that the strict rule left out, with the mark they missed."""
    late = _strict_stream(spark, sf)[1]
    return late.select("AccountID", "_row_number", "_ingested_at", "_late_after")


@query("stream_str_customers", O.over([O.RAW_C, O.RAW_C_UPD, O.RAW_C_ALL], O.str_customers_sql("raw_customers_all", None, O.RUN_1)))
def q_stream_str_customers(spark, sf):
    """Streamed customers, first file and update file, equal the batch model's table."""
    return _streamed(spark, CUSTOMER_STREAM, T.raw_customers(spark, sf).unionByName(T.customer_updates(spark, sf)))


@query("stream_upsert", O.over(O.FULL, """
select account_id, account_type, cast(original_balance as double) as original_balance, customer_id,
       data_quality_flag, _last_processed_at from str_accounts"""))
def q_stream_upsert(spark, sf):
    """Raw account files streamed in several micro-batches; each batch merged keep-latest, exactly once."""
    out = _streamed(spark, ACCOUNT_STREAM, T.raw_accounts(spark, sf))
    return present(out.select("account_id", "account_type", "original_balance", "customer_id", "data_quality_flag",
                              "_last_processed_at"))


@query("csv_export_roundtrip", O.over(O.FULL, O.summary_sql("fact")))
def q_csv_export_roundtrip(spark, sf):
    """Export the report as ordered CSV part files with a header, written by range in parallel, then read them back."""
    report = present(M.account_summary(curated_full(spark, sf)[2], ordered=False))
    path = work_dir(spark, "export")
    export_csv(report, path, ["customer_id", "account_id"], single_file=False)
    return spark.read.options(**L.CSV_TEXT).option("header", True).schema(report.schema).csv(path)


@query("lineage_trace", O.over(O.FULL, """
select account_id, json_extract_string(metadata_json, '$.source_file') as source_file,
       json_extract_string(metadata_json, '$.row_number') as row_number,
       json_extract_string(metadata_json, '$.file_hash') as file_hash,
       json_extract_string(metadata_json, '$.ingested_at') as ingested_at,
       json_extract_string(metadata_json, '$.data_quality_flag') as data_quality_flag
from str_accounts"""))
def q_lineage_trace(spark, sf):
    acc = structured_full(spark, sf)[0]
    return acc.select("account_id", *[F.get_json_object("metadata_json", f"$.{k}").alias(k)
                                      for k in ("source_file", "row_number", "file_hash", "ingested_at",
                                                "data_quality_flag")])


@query("audit_history", O.over(O.TWO_RUNS, """
select d.account_id,
       json_extract_string(coalesce(e.metadata_json, d.metadata_json), '$.row_number') as top_row_number,
       cast(case when e.account_id is null then 0
                 else coalesce(json_array_length(e.metadata_json, '$.history'), 0) + 1 end as integer) as history_length,
       case when e.account_id is not null then json_extract_string(d.metadata_json, '$.row_number') end
           as first_history_row_number
from str_accounts_d2 d left join str_accounts_r1 e on d.account_id = e.account_id"""))
def q_audit_history(spark, sf):
    """Run-2 changes carry the run-1 lineage plus one history entry."""
    r = two_runs(spark, sf)
    old = r["acc1"].select("account_id", F.col("metadata_json").alias("_old_meta"))
    d = r["acc_d2"].join(old, "account_id", "left")
    src = {k: F.get_json_object("metadata_json", f"$.{k}") for k in ("source_file", "row_number", "file_hash",
                                                                    "ingested_at")}
    d = d.select("account_id", "metadata_json", "_old_meta", *[v.alias(f"_h_{k}") for k, v in src.items()])
    entry = history_entry("_h_source_file", "_h_row_number", "_h_file_hash", "_h_ingested_at",
                          F.lit(O.RUN_2).cast("timestamp_ntz"))
    meta = append_history(F.col("_old_meta"), F.col("metadata_json"), entry).alias("audit_json")
    out = d.select("account_id", meta)
    return out.select("account_id",
                      F.get_json_object("audit_json", "$.row_number").alias("top_row_number"),
                      F.json_array_length(F.get_json_object("audit_json", "$.history")).alias("history_length"),
                      F.get_json_object("audit_json", "$.history[0].row_number").alias("first_history_row_number"))
