"""Registered queries: landing scan, lineage, fingerprints, ledgers, schema drift (§2.A, §2.B, §2.G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.functions.columns import NA_TOKENS
from vaultline.operators.schema import detect_schema, latest_versions, schema_drift, schema_json
from vaultline.plans import oracle as O
from vaultline.plans.ingest import ACCOUNTS, CUSTOMERS, Catalog, Source, ingest
from vaultline.plans.present import present
from vaultline.plans.registry import query
from vaultline.session import materialize, work_dir
from vaultline.sinks.ledgers import ledger_report, process_report, schema_report
from vaultline.sinks.tables import _FS, append_raw, read_raw, reload_raw
from vaultline.sources import landing as L
from vaultline.sources import landing_fixtures as LF
from vaultline.sources import testdata as T

FIRST_MONTHS = "month < '1997-01'"
_NA = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def _na(c: str) -> str:
    return f"case when {c} in ({_NA}) then null else {c} end"


RAW_A_MONTH = ("raw_accounts_m", f"""
select {_na('AccountID')} as AccountID, {_na('CustomerID')} as CustomerID, {_na('Balance')} as Balance,
       {_na('AccountType')} as AccountType, strftime(_ingested_at, '%Y-%m') as month, _row_number as okey_rn,
       (_row_number - 1) // {LF.SLICE} as slice
from raw_accounts""")
RAW_A_PRIO = ("raw_accounts_p", f"""
select m.*, {_na('o.o_orderpriority')} as Priority from raw_accounts_m m join orders o on m.okey_rn = o.o_orderkey + 1""")


def _landing_all_months(spark, sf):
    root = work_dir(spark, "landing")
    LF.write_csv(LF.account_source_rows(spark, sf), f"{root}/accounts")
    return f"{root}/accounts"


def _two_ingest_runs(spark, sf, fail_first: bool = False):
    """Run 1 ingests the pre-1997 account files and the customer files; run 2 the
    later account files, which carry an extra ``Priority`` column (schema drift)."""
    root = work_dir(spark, "landing")
    cat = Catalog(work_dir(spark, "catalog"))
    acc_dir, cust_dir = f"{root}/accounts", f"{root}/customers"
    LF.write_csv(LF.account_source_rows(spark, sf).filter(FIRST_MONTHS), acc_dir)
    LF.write_csv(LF.customer_source_rows(spark, sf), cust_dir, part="nation")
    if fail_first:
        broken = Source("accounts", "raw_accounts", ACCOUNTS.columns + ("Currency",), ACCOUNTS.aliases)
        try:
            ingest(spark, cat, broken, acc_dir, O.RUN_1, mode="all_unseen")
        except ValueError:
            pass  # recorded as failed in the ledger
    ingest(spark, cat, ACCOUNTS, acc_dir, O.RUN_1, mode="all_unseen")
    ingest(spark, cat, CUSTOMERS, cust_dir, O.RUN_1, mode="all_unseen")
    second = LF.account_source_rows(spark, sf, extra_priority=True).filter(f"not ({FIRST_MONTHS})")
    LF.write_csv(second, acc_dir, mode="append")
    return cat, acc_dir


def _after_run_2(spark, sf, fail_first: bool = False):
    cat, acc_dir = _two_ingest_runs(spark, sf, fail_first)
    ingest(spark, cat, ACCOUNTS, acc_dir, O.RUN_2, mode="all_unseen")
    return cat


# ---------------------------------------------------------------- A1, A2, A6

@query("csv_scan", O.over([O.RAW_A, RAW_A_MONTH], "select AccountID, CustomerID, Balance, AccountType "
                                                  "from raw_accounts_m"))
def q_csv_scan(spark, sf):
    return L.scan_csv(spark, _landing_all_months(spark, sf), L.ACCOUNT_COLUMNS, L.ACCOUNT_ALIASES) \
        .select(*L.ACCOUNT_COLUMNS)


@query("lineage_columns", O.over([O.RAW_A, RAW_A_MONTH], f"""
select AccountID, month, row_number() over (partition by month, slice order by okey_rn) as _row_number,
       {O.lit_ts(O.RUN_1)} as _ingested_at, 32 as hash_length
from raw_accounts_m"""))
def q_lineage_columns(spark, sf):
    path = _landing_all_months(spark, sf)
    scanned = L.scan_csv(spark, path, L.ACCOUNT_COLUMNS, L.ACCOUNT_ALIASES)
    rows = L.with_lineage(scanned, L.fingerprint(spark, path), O.RUN_1)
    return rows.select("AccountID", LF.month_of(F.col("_source_file")).alias("month"), "_row_number",
                       "_ingested_at", F.length("_file_hash").alias("hash_length"))


def _quoted(c: str) -> str:
    return f"""case when contains({c}, ',') then '"' || {c} || '"' else coalesce({c}, '') end"""


# The text of each landing file, rebuilt: a header line, then the rows in key order.
FILE_TEXT = ("file_text", f"""
select month, slice, 'AccountID,CustomerID,Balance,AccountType' || chr(10) || string_agg(
       AccountID || ',' || CustomerID || ',' || {_quoted('Balance')} || ',' || AccountType || chr(10), '' order by okey) as body
from (select *, strftime(_ingested_at, '%Y-%m') as month, _row_number - 1 as okey, (_row_number - 1) // {LF.SLICE} as slice
      from raw_accounts) r group by month, slice""")


@query("file_fingerprint", O.over([O.RAW_A, FILE_TEXT], """
select month, cast(strlen(body) as bigint) as length, md5(body) as file_hash from file_text"""))
def q_file_fingerprint(spark, sf):
    path = _landing_all_months(spark, sf)
    return L.fingerprint(spark, path).select(LF.month_of(F.col("path")).alias("month"), "length", "file_hash")


@query("latest_file", O.over([O.RAW_A, FILE_TEXT], """
select month, cast(strlen(body) as bigint) as length from file_text order by month, slice limit 1"""))
def q_latest_file(spark, sf):
    """The first month's first file is touched last, so it is the newest."""
    path = _landing_all_months(spark, sf)
    first = L.list_landing(spark, path).orderBy("path").first().path
    files = _FS(spark, first)
    files.fs.setTimes(files.root, 4_000_000_000_000, -1)
    return L.latest_file(L.list_landing(spark, path)).select(LF.month_of(F.col("path")).alias("month"), "length")


# Deliveries whose columns stand in another order, one column more (even customers), and
# text that CSV has to quote: commas, quotes, backslashes, line breaks.
ODD_NAME = r"""case c_custkey % 5 when 0 then concat('Say "', c_name, '", ok')
    when 1 then concat(c_name, chr(10), 'second line') when 2 then concat(c_name, '\\')
    when 3 then concat('"', c_mktsegment, '"') else c_name end"""
ODD_NAME_DUCK = ODD_NAME.replace("\\\\", "\\")


def _odd_customers(spark, sf):
    cust = T.read_table(spark, sf, "customer")
    return cust.select(F.concat(F.lit("CUS"), F.col("c_custkey").cast("string")).alias("CustomerID"),
                       F.expr(ODD_NAME).alias("Name"), F.lit("yes").alias("HasLoan"), F.col("c_mktsegment").alias("Segment"),
                       (F.col("c_custkey") % 2).alias("odd"))


def _write_quoted(df, path):
    df.write.options(**L.CSV_TEXT).option("header", True).csv(path)


@query("csv_scan_mixed_headers", """
select concat('CUS', cast(c_custkey as varchar)) as CustomerID, c_name as Name, 'yes' as HasLoan,
       case when c_custkey % 2 = 0 then c_mktsegment end as Segment from customer""")
def q_csv_scan_mixed_headers(spark, sf):
    """Odd customers as (Name, CustomerID, HasLoan), even ones as (hasloan, customerid, Segment, name)."""
    rows = _odd_customers(spark, sf).drop("Name").join(
        T.read_table(spark, sf, "customer").select(F.concat(F.lit("CUS"), F.col("c_custkey").cast("string")).alias("CustomerID"),
                                                   F.col("c_name").alias("Name")), "CustomerID")
    root = work_dir(spark, "landing")
    _write_quoted(rows.where("odd = 1").select("Name", "CustomerID", "HasLoan"), f"{root}/a")
    _write_quoted(rows.where("odd = 0").select(F.col("HasLoan").alias("hasloan"), F.col("CustomerID").alias("customerid"),
                                               "Segment", F.col("Name").alias("name")), f"{root}/b")
    return L.scan_csv(spark, root, L.CUSTOMER_COLUMNS, L.CUSTOMER_ALIASES, keep_extra=True).drop("_path", "_block", "_pos")


@query("csv_scan_quoted", f"""
select concat('CUS', cast(c_custkey as varchar)) as CustomerID, {ODD_NAME_DUCK} as Name, 'yes' as HasLoan from customer""")
def q_csv_scan_quoted(spark, sf):
    """Quotes, backslashes, commas and line breaks inside fields come back as they were."""
    root = work_dir(spark, "landing")
    _write_quoted(_odd_customers(spark, sf).select("CustomerID", "Name", "HasLoan"), root)
    return L.scan_csv(spark, root, L.CUSTOMER_COLUMNS).select(*L.CUSTOMER_COLUMNS)


@query("csv_scan_quoted_splits", f"""
select concat('CUS', cast(c_custkey as varchar)) as CustomerID, {ODD_NAME_DUCK} as Name, 'yes' as HasLoan,
       row_number() over (order by c_custkey) as _row_number from customer""")
def q_csv_scan_quoted_splits(spark, sf):
    """One file with quoted line breaks, read in many splits: the records and their row numbers."""
    root, rows = work_dir(spark, "landing"), _odd_customers(spark, sf)
    key = F.regexp_replace("CustomerID", "[^0-9]", "").cast("bigint")
    _write_quoted(rows.select("CustomerID", "Name", "HasLoan").coalesce(1).sortWithinPartitions(key), root)
    files = materialize(L.fingerprint(spark, root), "landing_files").withColumn("length", F.lit(L.QUOTED_SPLIT_BYTES + 1))
    scanned = L.scan_csv(spark, [], L.CUSTOMER_COLUMNS, files=files)
    return L.with_row_numbers(scanned).select(*L.CUSTOMER_COLUMNS, "_row_number")


# ---------------------------------------------------------------- A5, K2, B1, B6, B7

@query("unprocessed_files", O.over([], "select strftime(o_orderdate, '%Y-%m') as month from orders "
                                      f"where o_orderdate >= timestamp '1997-01-01' group by 1, o_orderkey // {LF.SLICE}"))
def q_unprocessed_files(spark, sf):
    cat, acc_dir = _two_ingest_runs(spark, sf)
    ledger = cat.ledger(spark).read()
    pending = L.unprocessed(L.fingerprint(spark, acc_dir), ledger, "accounts")
    return pending.select(LF.month_of(F.col("path")).alias("month"))


@query("raw_append", O.over([O.RAW_A, RAW_A_MONTH, RAW_A_PRIO], f"""
select AccountID, CustomerID, Balance, AccountType,
       case when month >= '1997-01' then Priority end as Priority, month,
       row_number() over (partition by month, slice order by okey_rn) as _row_number,
       case when month >= '1997-01' then {O.lit_ts(O.RUN_2)} else {O.lit_ts(O.RUN_1)} end as _ingested_at
from raw_accounts_p"""))
def q_raw_append(spark, sf):
    cat = _after_run_2(spark, sf)
    raw = read_raw(spark, cat.raw("raw_accounts"))
    return raw.select(*L.ACCOUNT_COLUMNS, "Priority", LF.month_of(F.col("_source_file")).alias("month"),
                      "_row_number", "_ingested_at")


@query("file_ledger_upsert", O.over([O.RAW_A, RAW_A_MONTH], f"""
select 'accounts' as file_type, month, 'completed' as processing_status, count(*) as row_count,
       case when month >= '1997-01' then {O.lit_ts(O.RUN_2)} else {O.lit_ts(O.RUN_1)} end as ingestion_timestamp,
       cast(null as varchar) as error_message
from raw_accounts_m group by month, slice
union all
select 'customers', null, 'completed', count(*), {O.lit_ts(O.RUN_1)}, null from customer group by c_nationkey, c_custkey // {LF.SLICE}"""))
def q_file_ledger_upsert(spark, sf):
    """A first attempt fails (missing column) and is recorded; the retry turns the rows to completed."""
    cat = _after_run_2(spark, sf, fail_first=True)
    led = cat.ledger(spark).read()
    m = LF.month_of(F.col("file_path"))
    return led.select("file_type", F.when(m != "", m).alias("month"), "processing_status", "row_count",
                      "ingestion_timestamp", "error_message")


@query("ledger_report", O.over([O.RAW_A, RAW_A_MONTH], f"""
select 'accounts' as file_type, 'completed' as processing_status, count(*) as row_count,
       case when month >= '1997-01' then {O.lit_ts(O.RUN_2)} else {O.lit_ts(O.RUN_1)} end as ingestion_timestamp,
       cast(null as varchar) as error_message
from raw_accounts_m group by month, slice
union all
select 'customers', 'completed', count(*), {O.lit_ts(O.RUN_1)}, null from customer group by c_nationkey, c_custkey // {LF.SLICE}"""))
def q_ledger_report(spark, sf):
    """The ingestion history report (file names are Spark's and left out)."""
    cat = _after_run_2(spark, sf)
    return ledger_report(cat.ledger(spark).read()).drop("file_name")


class _LostLedger(Catalog):
    """The same raw tables, but a ledger that is gone: a run that died between the two."""

    def ledger(self, spark):
        return self.table(spark, "lost", "file_ingestion_metadata")


CLEAN_LOAD = O.over([O.RAW_A, RAW_A_MONTH], f"""
select AccountID, CustomerID, Balance, AccountType, month, row_number() over (partition by month, slice order by okey_rn) as _row_number,
       {O.lit_ts(O.RUN_1)} as _ingested_at from raw_accounts_m""")


def _raw_rows(spark, cat):
    raw = read_raw(spark, cat.raw("raw_accounts"))
    return raw.select(*L.ACCOUNT_COLUMNS, LF.month_of(F.col("_source_file")).alias("month"), "_row_number", "_ingested_at")


@query("ingest_retry", CLEAN_LOAD)
def q_ingest_retry(spark, sf):
    """A run dies after its rows were written and before the ledger knew; the retry adds none twice."""
    landing, root = _landing_all_months(spark, sf), work_dir(spark, "catalog")
    ingest(spark, _LostLedger(root), ACCOUNTS, landing, O.RUN_1, mode="all_unseen")
    ingest(spark, Catalog(root), ACCOUNTS, landing, O.RUN_2, mode="all_unseen")
    return _raw_rows(spark, Catalog(root))


# Deliveries of every third month are bad: in March files lack a column, in June the header is not
# UTF-8, in December balances are not quoted, so records with a comma in them are too long.
BAD_MONTHS = "case substring(month, 6, 2) when '03' then 'column' when '06' then 'bytes' when '12' then 'quotes' else 'good' end"


def _bad_deliveries(spark, sf):
    root, rows = work_dir(spark, "landing"), LF.account_source_rows(spark, sf).withColumn("kind", F.expr(BAD_MONTHS))
    LF.write_csv(rows.where("kind = 'good'").drop("kind"), f"{root}/good")
    LF.write_csv(rows.where("kind = 'column'").drop("kind", "AccountType"), f"{root}/column")
    LF.write_csv(rows.where("kind = 'bytes'").drop("kind").withColumnRenamed("Balance", "Bal\u00e4nce"), f"{root}/bytes", encoding="ISO-8859-1")
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in L.ACCOUNT_COLUMNS]).alias(",".join(L.ACCOUNT_COLUMNS))
    LF.write_csv(rows.where("kind = 'quotes'").select(line, "month", "slice", "okey"), f"{root}/quotes", sep="\u0001")
    return root


DELIVERED = ("delivered", f"""
select *, {BAD_MONTHS} as kind, {BAD_MONTHS} = 'quotes' and coalesce(contains(Balance, ','), false) as too_long,
       {BAD_MONTHS} in ('column', 'bytes') as failed, cast(regexp_replace(AccountID, '[^0-9]', '', 'g') as bigint) as key
from raw_accounts_m""")


@query("ingest_quarantine", O.over([O.RAW_A, RAW_A_MONTH, DELIVERED], """
select month, case when failed then 'failed' else 'completed' end as processing_status,
       count(*) filter (where not failed and not too_long) as row_count,
       count(*) filter (where not failed and not too_long) as raw_rows,
       cast(coalesce(sum(key) filter (where not failed and not too_long), 0) as bigint) as raw_keys,
       count(*) filter (where too_long) as rejected,
       case kind when 'column' then 'lacks columns' when 'bytes' then 'UnicodeDecodeError' else '' end as error
from delivered group by month, slice, kind, failed"""))
def q_ingest_quarantine(spark, sf):
    """Bad files among good ones: each file's ledger entry, and what is in the raw and the rejects table."""
    cat, root = Catalog(work_dir(spark, "catalog")), _bad_deliveries(spark, sf)
    ingest(spark, cat, ACCOUNTS, root, O.RUN_1, mode="all_unseen")
    led = cat.ledger(spark).read()
    key = F.regexp_replace("AccountID", "[^0-9]", "").cast("bigint")
    raw = read_raw(spark, cat.raw("raw_accounts")).groupBy("_file_hash").agg(F.count(F.lit(1)).alias("raw_rows"), F.sum(key).alias("raw_keys"))
    bad = read_raw(spark, cat.rejects("raw_accounts")).groupBy("_file_hash").agg(F.count(F.lit(1)).alias("rejected"))
    found = led.join(raw, led["file_hash"] == raw["_file_hash"], "left").drop("_file_hash")
    found = found.join(bad, led["file_hash"] == bad["_file_hash"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("raw_rows", "raw_keys", "rejected")]
    error = F.regexp_extract(F.coalesce("error_message", F.lit("")), "lacks columns|UnicodeDecodeError", 0)
    return found.select(LF.month_of(F.col("file_path")).alias("month"), "processing_status", "row_count", *zero, error.alias("error"))


@query("pair_gate", O.over([O.RAW_A, RAW_A_MONTH], f"""
select count(*) > 0 as accounts_ready, false as customers_ready, false as ready
from raw_accounts_m where month >= '1997-01'"""))
def q_pair_gate(spark, sf):
    """After run 1, only new account files arrive: the accounts/customers pair is incomplete."""
    from vaultline.plans.gates import pair_gate
    cat = _after_run_2(spark, sf)
    return pair_gate(cat.ledger(spark).read(), since=O.RUN_1)


# ---------------------------------------------------------------- E9, G2, G3, B8

def _type_sql(c: str, t: str) -> str:
    """The CSV reader's type of a text column: whole numbers, else numbers, else truth words, else text."""
    return f"""(select case when count({c}) = 0 then 'float64'
        when count(*) filter (where {c} is not null and not regexp_matches({c}, '^\\s*[-+]?[0-9]+\\s*$')) = 0
             and count(*) filter (where {c} is null) = 0 then 'int64'
        when count(*) filter (where {c} is not null and (try_cast(trim({c}) as double) is null or regexp_matches({c}, '[a-zA-Z_]') and
             not regexp_matches(lower(trim({c})), '^[-+]?([0-9.]+e[-+]?[0-9]+|inf|infinity)$'))) = 0 then 'float64'
        when count(*) filter (where {c} is not null and {c} not in ('True','False','TRUE','FALSE','true','false')) = 0
             and count(*) filter (where {c} is null) = 0 then 'bool'
        else 'object' end from {t})"""


def _nullable_sql(c: str, t: str) -> str:
    return f"(select coalesce(bool_or({c} is null), false) from {t})"


def _schema_rows_sql(cols, t: str) -> str:
    return "\nunion all\n".join(
        f"select {i} as ordinal, '{c}' as name, {_type_sql(c, t)} as type, {_nullable_sql(c, t)} as nullable"
        for i, c in enumerate(cols))


def _defs_json_sql(cols, t: str) -> str:
    parts = []
    for c in cols:
        parts.append(f"""'{{"name":"{c}","type":"' || {_type_sql(c, t)} || '","nullable":' ||
                     case when {_nullable_sql(c, t)} then 'true' else 'false' end || '}}'""")
    return "'[' || " + " || ',' || ".join(parts) + " || ']'"


RAW_C_NA = ("raw_customers_na", f"select {_na('CustomerID')} as CustomerID, {_na('Name')} as Name, "
                                f"{_na('HasLoan')} as HasLoan from raw_customers")


@query("detect_schema", O.over([O.RAW_A, O.RAW_C, RAW_A_MONTH, RAW_C_NA], f"""
select 'raw_accounts' as table_name, * from ({_schema_rows_sql(L.ACCOUNT_COLUMNS, 'raw_accounts_m')})
union all
select 'raw_customers', * from ({_schema_rows_sql(L.CUSTOMER_COLUMNS, 'raw_customers_na')})"""))
def q_detect_schema(spark, sf):
    from vaultline.functions.columns import na_to_null
    acc = T.raw_accounts(spark, sf).select(*[na_to_null(c).alias(c) for c in L.ACCOUNT_COLUMNS])
    cust = T.raw_customers(spark, sf).select(*[na_to_null(c).alias(c) for c in L.CUSTOMER_COLUMNS])
    return detect_schema(acc).select(F.lit("raw_accounts").alias("table_name"), "*") \
        .unionByName(detect_schema(cust).select(F.lit("raw_customers").alias("table_name"), "*"))


_RUN1_ACC = ("acc_r1", "select * from raw_accounts_p where month < '1997-01'")
_RUN2_ACC = ("acc_r2", "select * from raw_accounts_p where month >= '1997-01'")
_V1 = _defs_json_sql(L.ACCOUNT_COLUMNS, "acc_r1")
_V2 = _defs_json_sql(L.ACCOUNT_COLUMNS + ("Priority",), "acc_r2")
_C1 = _defs_json_sql(L.CUSTOMER_COLUMNS, "raw_customers_na")
_LOG_CTES = [O.RAW_A, O.RAW_C, RAW_A_MONTH, RAW_A_PRIO, RAW_C_NA, _RUN1_ACC, _RUN2_ACC,
             ("defs", f"select {_V1} as v1, {_V2} as v2, {_C1} as c1"),
             ("log", f"""
select sha256('raw_accounts|1|' || v1) as schema_id, 'raw_accounts' as table_name, 1 as schema_version,
       v1 as column_definitions, {O.lit_ts(O.RUN_1)} as detected_at, cast(null as varchar) as previous_version_id,
       'Initial schema' as change_description from defs
union all
select sha256('raw_customers|1|' || c1), 'raw_customers', 1, c1, {O.lit_ts(O.RUN_1)}, null, 'Initial schema' from defs
union all
select sha256('raw_accounts|2|' || v2), 'raw_accounts', 2, v2, {O.lit_ts(O.RUN_2)},
       sha256('raw_accounts|1|' || v1), 'Schema change detected' from defs""")]


@query("schema_version_log", O.over(_LOG_CTES, "select * from log"))
def q_schema_version_log(spark, sf):
    cat = _after_run_2(spark, sf)
    return cat.schema_log(spark).read()


@query("latest_schema_version", O.over(_LOG_CTES, """
select table_name, schema_id, schema_version, column_definitions, detected_at from log
qualify row_number() over (partition by table_name order by schema_version desc) = 1"""))
def q_latest_schema_version(spark, sf):
    cat = _after_run_2(spark, sf)
    return latest_versions(cat.schema_log(spark).read())


@query("schema_drift", O.over(_LOG_CTES, """
select 'raw_accounts' as table_name, v2 as column_definitions, true as changed, 2 as schema_version,
       sha256('raw_accounts|1|' || v1) as previous_version_id, 'Schema change detected' as change_description
from defs"""))
def q_schema_drift(spark, sf):
    """Drift of the second account delivery (extra Priority column) against the logged run-1 schema."""
    cat, acc_dir = _two_ingest_runs(spark, sf)
    log = cat.schema_log(spark).read()
    ledger = cat.ledger(spark).read()
    pending = materialize(L.unprocessed(L.fingerprint(spark, acc_dir), ledger, "accounts"), "pending")
    scanned = L.scan_csv(spark, [], L.ACCOUNT_COLUMNS, L.ACCOUNT_ALIASES, keep_extra=True, files=pending)
    cols = [c for c in scanned.columns if not c.startswith("_")]
    return schema_drift(schema_json(detect_schema(scanned, cols), "raw_accounts"), log)


@query("schema_report", O.over(_LOG_CTES, """
select table_name, schema_version, detected_at, change_description, column_definitions from log"""))
def q_schema_report(spark, sf):
    cat = _after_run_2(spark, sf)
    return schema_report(cat.schema_log(spark).read())


RUNS = ("runs", f"""
select {O.lit_ts(O.RUN_1)} as run_timestamp, (select count(*) from str_accounts_r1) as p, 0 as u
union all
select {O.lit_ts(O.RUN_2)}, (select count(*) from str_accounts_d2),
       (select count(*) from str_accounts_d2 d where exists (select 1 from str_accounts_r1 e where e.account_id = d.account_id))""")


@query("process_log", O.over([*O.TWO_RUNS, RUNS], f"""
select run_timestamp, 'str_accounts' as target_table, 'raw_accounts' as source_tables, p as records_processed,
       p - u as records_inserted, cast(u as bigint) as records_updated, 'completed' as status, cast(null as varchar) as error_message
from runs
union all
select {O.lit_ts(O.RUN_2)}, 'dim_account', 'str_accounts', 0, 0, 0, 'failed', 'source is gone'"""))
def q_process_log(spark, sf):
    """Two merges of the accounts and a failed one of the dimension, as the process log reports them."""
    from vaultline.plans import models as M
    from vaultline.plans.runner import merge_target
    cat = Catalog(work_dir(spark, "catalog"))
    raw = T.raw_accounts(spark, sf)
    for source, run in ((T.account_deliveries(spark, sf)[0], O.RUN_1), (raw, O.RUN_2)):
        merge_target(spark, cat, "structured", "str_accounts", "account_id",
                     lambda e, source=source, run=run: M.str_accounts(source, e, run), run, "raw_accounts")

    def gone(existing):
        raise OSError("source is gone")

    try:
        merge_target(spark, cat, "curated", "dim_account", "account_id", gone, O.RUN_2, "str_accounts")
    except OSError:
        pass
    return process_report(cat.process_log(spark).read()).drop("duration_seconds")


# ---------------------------------------------------------------- A7, I9

@query("raw_reload", O.over([O.RAW_A], f"select AccountID, CustomerID, Balance, AccountType, _row_number, {O.lit_ts(O.RUN_2)} as _ingested_at "
                                       "from raw_accounts"))
def q_raw_reload(spark, sf):
    """A raw table that holds another delivery is dropped and loaded again with the whole one."""
    raw, path = T.raw_accounts(spark, sf), work_dir(spark, "raw")
    at = lambda run: F.lit(run).cast("timestamp_ntz")
    append_raw(raw.where("_row_number % 3 = 0").withColumns({"_file_hash": F.md5(F.lit("older")), "_ingested_at": at(O.RUN_1)}), path)
    reload_raw(raw.withColumn("_ingested_at", at(O.RUN_2)), path)
    return read_raw(spark, path).select(*L.ACCOUNT_COLUMNS, "_row_number", "_ingested_at")


# The accounts as their landing files carry them: rows numbered by file, all ingested at once.
LANDED_A = ("landed_accounts", f"""
select m.AccountID, m.CustomerID, m.Balance, m.AccountType, '' as _source_file, md5(t.body) as _file_hash,
       row_number() over (partition by m.month, m.slice order by m.okey_rn) as _row_number, {O.lit_ts(O.RUN_1)} as _ingested_at
from raw_accounts_m m join file_text t on t.month = m.month and t.slice = m.slice""")
LANDED_C = ("landed_customers", f"""
select CustomerID, {_na('Name')} as Name, {_na('HasLoan')} as HasLoan, '' as _source_file, '' as _file_hash, _row_number,
       {O.lit_ts(O.RUN_1)} as _ingested_at from raw_customers""")


@query("whole_run", O.over([O.RAW_A, O.RAW_C, RAW_A_MONTH, FILE_TEXT, LANDED_A, LANDED_C,
                            ("str_accounts", O.str_accounts_sql("landed_accounts", None, O.RUN_1)),
                            ("str_customers", O.str_customers_sql("landed_customers", None, O.RUN_1)),
                            ("fact", O.fact_sql("str_accounts", "str_customers", None, O.RUN_1))], O.summary_sql("fact")))
def q_whole_run(spark, sf):
    """The whole job over landing files: ingestion, structured, curated and access layers, checks; the report it stores."""
    from vaultline.plans.runner import run_all
    landing, root = work_dir(spark, "landing"), work_dir(spark, "warehouse")
    LF.write_csv(LF.account_source_rows(spark, sf), f"{landing}/accounts")
    LF.write_csv(LF.customer_source_rows(spark, sf), f"{landing}/customers", part="nation")
    run_all(spark, root, f"{landing}/accounts", f"{landing}/customers", O.RUN_1)
    return present(Catalog(root).table(spark, "access", "account_summary").read())
