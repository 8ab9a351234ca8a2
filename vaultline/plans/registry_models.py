"""Registered queries: structured / curated models, scalar rules, filters, joins, aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vaultline.functions import columns as C
from vaultline.operators.incremental import has_new
from vaultline.operators.quality import orphan_accounts
from vaultline.plans import models as M
from vaultline.plans import oracle as O
from vaultline.plans.present import present
from vaultline.plans.registry import curated_full, query, structured_full, two_runs
from vaultline.sources import testdata as T

FULL, TWO = O.FULL, O.TWO_RUNS
over = O.over

# ---------------------------------------------------------------- I1–I5 models

@query("str_accounts_full", over(FULL, f"select * {O.money('original_balance')} from str_accounts"))
def q_str_accounts_full(spark, sf):
    return present(structured_full(spark, sf)[0])


@query("str_customers_full", over(FULL, "select * from str_customers"))
def q_str_customers_full(spark, sf):
    return structured_full(spark, sf)[1]


@query("str_accounts_incremental", over(TWO, f"select * {O.money('original_balance')} from str_accounts_d2"))
def q_str_accounts_incremental(spark, sf):
    return present(two_runs(spark, sf)["acc_d2"])


@query("str_customers_incremental", over(TWO, "select * from str_customers_d2"))
def q_str_customers_incremental(spark, sf):
    return two_runs(spark, sf)["cust_d2"]


@query("merge_upsert", over(TWO, f"select * {O.money('original_balance')} from str_accounts_r2"))
def q_merge_upsert(spark, sf):
    return present(two_runs(spark, sf)["acc2"])


@query("dim_account_full", over(FULL, f"select account_id, account_type, cast(original_balance as double) as "
                                      "original_balance, customer_id, created_date, modified_date, metadata_json "
                                      "from str_accounts"))
def q_dim_account_full(spark, sf):
    return present(M.dim_account(structured_full(spark, sf)[0]))


@query("dim_account_incremental", over(TWO + [O.DIM_ACC_R1], """
select a.account_id, a.account_type, cast(a.original_balance as double) as original_balance, a.customer_id,
       a.created_date, a.modified_date, a.metadata_json
from str_accounts_r2 a left join dim_account_r1 e on a.account_id = e.account_id
where e.account_id is null or a.modified_date > coalesce(e.modified_date, timestamp '1900-01-01')"""))
def q_dim_account_incremental(spark, sf):
    r = two_runs(spark, sf)
    dim1 = M.dim_account(r["acc1"])
    return present(M.dim_account(r["acc2_stored"], dim1))


@query("empty_relation", over(FULL, "select account_id, account_type, cast(original_balance as double) as "
                                    "original_balance, customer_id from str_accounts"))
def q_empty_relation(spark, sf):
    """First run against an empty typed target: every account is new."""
    acc = structured_full(spark, sf)[0]
    empty = spark.createDataFrame([], M.dim_account(acc).schema)
    return present(M.dim_account(acc, empty).select("account_id", "account_type", "original_balance", "customer_id"))


@query("dim_customer_full", over(FULL, "select customer_id, customer_name, hasloan, created_date, modified_date, "
                                       "metadata_json from str_customers"))
def q_dim_customer_full(spark, sf):
    return M.dim_customer(structured_full(spark, sf)[1])


@query("dim_customer_incremental", over(TWO + [O.DIM_CUST_R1], """
select customer_id, customer_name, hasloan, created_date, modified_date, metadata_json from str_customers_r2
where modified_date > (select coalesce(max(modified_date), timestamp '1900-01-01') from dim_customer_r1)"""))
def q_dim_customer_incremental(spark, sf):
    r = two_runs(spark, sf)
    return M.dim_customer(r["cust2"], M.dim_customer(r["cust1"]))


@query("fact_full", over(FULL, f"select * {O.FACT_MONEY} from fact"))
def q_fact_full(spark, sf):
    return present(curated_full(spark, sf)[2])


@query("fact_incremental", over(TWO, f"select * {O.FACT_MONEY} from fact_d2"))
def q_fact_incremental(spark, sf):
    return present(two_runs(spark, sf)["fact_d2"])


@query("preserve_created_date", over(TWO, "select account_id, created_date, modified_date from fact_r2"))
def q_preserve_created_date(spark, sf):
    return two_runs(spark, sf)["fact2"].select("account_id", "created_date", "modified_date")


# ---------------------------------------------------------------- §2.H scalar rules

@query("clean_accounts", over(FULL, "select * exclude (_source_file, _file_hash) "
                                    f"{O.money('original_balance')} from ({O.clean_accounts_sql('raw_accounts')})"))
def q_clean_accounts(spark, sf):
    return present(M.clean_accounts(T.raw_accounts(spark, sf)).drop("_source_file", "_file_hash"))


@query("parse_balance", over([O.RAW_A], """
select _row_number, Balance as balance_text,
       cast(try_cast(replace(trim(cast(Balance as varchar)), ',', '') as decimal(15,2)) as double) as original_balance
from raw_accounts"""))
def q_parse_balance(spark, sf):
    return present(T.raw_accounts(spark, sf).select("_row_number", F.col("Balance").alias("balance_text"),
                                                    C.parse_balance("Balance").alias("original_balance")))


@query("impute_balance", over(FULL, f"""
select _row_number, cast(original_balance as double) as original_balance, data_quality_flag
from ({O.clean_accounts_sql('raw_accounts')})"""))
def q_impute_balance(spark, sf):
    return present(M.clean_accounts(T.raw_accounts(spark, sf))
                   .select("_row_number", "original_balance", "data_quality_flag"))


@query("title_case", over([O.RAW_C], f"select CustomerID, Name, {O.TITLE_CASE_SQL.format(c='Name')} as customer_name "
                                     "from raw_customers"))
def q_title_case(spark, sf):
    return T.raw_customers(spark, sf).select("CustomerID", "Name", C.title_case("Name").alias("customer_name"))


@query("initcap_name", over([O.RAW_C], """
select CustomerID, array_to_string(list_transform(string_split(trim(Name), ' '),
       lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ') as customer_name from raw_customers"""))
def q_initcap_name(spark, sf):
    """The plain ``initcap`` of a name, which keeps inner double spaces."""
    return T.raw_customers(spark, sf).select("CustomerID", F.initcap(F.trim("Name")).alias("customer_name"))


@query("standardize_boolean", over([O.RAW_C], f"select CustomerID, HasLoan as hasloan_text, "
                                              f"{O.BOOL_SQL.format(c='HasLoan')} as hasloan from raw_customers"))
def q_standardize_boolean(spark, sf):
    return T.raw_customers(spark, sf).select("CustomerID", F.col("HasLoan").alias("hasloan_text"),
                                             C.standardize_boolean("HasLoan").alias("hasloan"))


_NA_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in C.NA_TOKENS)


@query("na_normalize", over([O.RAW_C], f"""
select CustomerID, case when Name in ({_NA_LIST}) then null else Name end as Name,
       case when HasLoan in ({_NA_LIST}) then null else HasLoan end as HasLoan
from raw_customers"""))
def q_na_normalize(spark, sf):
    r = T.raw_customers(spark, sf)
    return r.select("CustomerID", C.na_to_null("Name").alias("Name"), C.na_to_null("HasLoan").alias("HasLoan"))


@query("interest_rate_tiers", over(FULL, "select account_id, cast(original_balance as double) as original_balance, "
                                         "hasloan, cast(interest_rate as double) as interest_rate from fact"))
def q_interest_rate_tiers(spark, sf):
    return present(curated_full(spark, sf)[2].select("account_id", "original_balance", "hasloan", "interest_rate"))


@query("interest_amounts", over(FULL, "select account_id, cast(annual_interest as double) as annual_interest, "
                                      "cast(new_balance as double) as new_balance from fact"))
def q_interest_amounts(spark, sf):
    return present(curated_full(spark, sf)[2].select("account_id", "annual_interest", "new_balance"))


@query("lineage_json", over(FULL, "select account_id, metadata_json from str_accounts "
                                  "union all select customer_id, metadata_json from str_customers"))
def q_lineage_json(spark, sf):
    acc, cust = structured_full(spark, sf)
    return acc.select("account_id", "metadata_json").unionByName(
        cust.select(F.col("customer_id").alias("account_id"), "metadata_json"))


# ---------------------------------------------------------------- §2.C filters, §2.D joins

@query("filter_valid_keys", over([O.RAW_A], "select AccountID, _row_number from raw_accounts "
                                            "where AccountID is not null and trim(AccountID) <> ''"))
def q_filter_valid_keys(spark, sf):
    r = T.raw_accounts(spark, sf)
    return r.filter(M._valid_key("AccountID")).select("AccountID", "_row_number")


@query("savings_filter", over(FULL, "select account_id, account_type, customer_id from str_accounts "
                                    "where account_type = 'savings'"))
def q_savings_filter(spark, sf):
    return M.savings_accounts(structured_full(spark, sf)[0]).select("account_id", "account_type", "customer_id")


@query("watermark_filter", over(TWO, """
select AccountID, _row_number, _ingested_at from raw_accounts
where _ingested_at > (select coalesce(max(_last_processed_at), timestamp '1900-01-01') from str_accounts_r1)"""))
def q_watermark_filter(spark, sf):
    from vaultline.operators.incremental import since_watermark
    r = two_runs(spark, sf)
    return since_watermark(T.raw_accounts(spark, sf), "_ingested_at", r["acc1"], "_last_processed_at") \
        .select("AccountID", "_row_number", "_ingested_at")


@query("join_accounts_customers", over(FULL, """
select a.account_id, a.customer_id, c.customer_name, c.hasloan
from str_accounts a join str_customers c on a.customer_id = c.customer_id where a.account_type = 'savings'"""))
def q_join_accounts_customers(spark, sf):
    acc, cust = structured_full(spark, sf)
    return M.join_accounts_customers(M.savings_accounts(acc), cust) \
        .select("account_id", "customer_id", "customer_name", "hasloan")


@query("orphan_accounts", over(FULL, """
select account_id, customer_id from str_accounts a
where not exists (select 1 from str_customers c where c.customer_id = a.customer_id)"""))
def q_orphan_accounts(spark, sf):
    return orphan_accounts(*structured_full(spark, sf))


SEEDED_CUSTOMERS = ("raw_customers_seeded", "select r.* from raw_customers r join customer c "
                    "on r.CustomerID = concat('CUS', cast(c.c_custkey as varchar)) where c.c_acctbal >= 0")


def seeded_customers(spark, sf):
    """Seeded violation: the customer file arrives without the customers in arrears."""
    cust = T.read_table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0) \
        .select(F.concat(F.lit("CUS"), F.col("c_custkey").cast("string")).alias("CustomerID"))
    return T.raw_customers(spark, sf).join(cust, "CustomerID", "left_semi")


@query("orphan_accounts_seeded", over(FULL + [SEEDED_CUSTOMERS,
                                              ("str_customers_seeded",
                                               O.str_customers_sql("raw_customers_seeded", None, O.RUN_1))], """
select account_id, customer_id from str_accounts a
where not exists (select 1 from str_customers_seeded c where c.customer_id = a.customer_id)"""))
def q_orphan_accounts_seeded(spark, sf):
    acc = structured_full(spark, sf)[0]
    cust = M.str_customers(seeded_customers(spark, sf), None, O.RUN_1)
    return orphan_accounts(acc, cust)


@query("unprocessed_raw", over(TWO, """
select AccountID, _row_number from raw_accounts r
where not exists (select 1 from str_accounts_r1 s where s.account_id = trim(cast(r.AccountID as varchar)))"""))
def q_unprocessed_raw(spark, sf):
    r = two_runs(spark, sf)
    raw = T.raw_accounts(spark, sf)
    return has_new(raw, r["acc1"], F.trim(raw["AccountID"]), "account_id").select("AccountID", "_row_number")


@query("unprocessed_structured", over(TWO, """
select s.account_id from str_accounts_r2 s where s.account_type = 'savings'
and not exists (select 1 from fact_r1 f where f.account_id = s.account_id)"""))
def q_unprocessed_structured(spark, sf):
    r = two_runs(spark, sf)
    sav = M.savings_accounts(r["acc2"])
    return has_new(sav, r["fact1"], sav["account_id"], "account_id").select("account_id")


@query("dedupe_latest_accounts", over(FULL, f"""
select account_id, _row_number, _ingested_at, cast(original_balance as double) as original_balance
from ({O.latest_sql(O.clean_accounts_sql('raw_accounts'), 'account_id')})"""))
def q_dedupe_latest_accounts(spark, sf):
    from vaultline.operators.dedupe import keep_latest
    c = M.clean_accounts(T.raw_accounts(spark, sf))
    return present(keep_latest(c, ["account_id"], M.latest_first())
                   .select("account_id", "_row_number", "_ingested_at", "original_balance"))


@query("dedupe_latest_customers", over([O.RAW_C, O.RAW_C_UPD, O.RAW_C_ALL], f"""
select customer_id, _row_number, _source_file, hasloan
from ({O.latest_sql(O.clean_customers_sql('raw_customers_all'), 'customer_id')})"""))
def q_dedupe_latest_customers(spark, sf):
    from vaultline.operators.dedupe import keep_latest
    raw = T.raw_customers(spark, sf).unionByName(T.customer_updates(spark, sf))
    return keep_latest(M.clean_customers(raw), ["customer_id"], M.latest_first()) \
        .select("customer_id", "_row_number", "_source_file", "hasloan")


# ---------------------------------------------------------------- §2.E aggregates

@query("layer_row_counts", over(FULL, """
select 'raw_accounts' as table_name, count(*) as row_count from raw_accounts
union all select 'raw_customers', count(*) from raw_customers
union all select 'str_accounts', count(*) from str_accounts
union all select 'str_customers', count(*) from str_customers
union all select 'fact_customer_balances', count(*) from fact
union all select 'account_summary', count(*) from fact where lower(account_type) = 'savings'"""))
def q_layer_row_counts(spark, sf):
    acc, cust, fact = curated_full(spark, sf)
    tables = [("raw_accounts", T.raw_accounts(spark, sf)), ("raw_customers", T.raw_customers(spark, sf)),
              ("str_accounts", acc), ("str_customers", cust), ("fact_customer_balances", fact),
              ("account_summary", M.account_summary(fact, ordered=False))]
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("summary_statistics", over(FULL, """
select count(*) as row_count,
       cast(sum(original_balance) as double) as total_original_balance,
       cast(sum(annual_interest) as double) as total_annual_interest,
       cast(sum(new_balance) as double) as total_new_balance,
       round(avg(cast(interest_rate as double)), 10) as avg_interest_rate
from fact where lower(account_type) = 'savings'"""))
def q_summary_statistics(spark, sf):
    from vaultline.sinks.export import summary_statistics
    return summary_statistics(M.account_summary(curated_full(spark, sf)[2], ordered=False))


@query("multi_account_customers", over(FULL, "select customer_id, count(*) as n_accounts from str_accounts "
                                             "group by customer_id having count(*) > 1"))
def q_multi_account_customers(spark, sf):
    acc = structured_full(spark, sf)[0]
    return acc.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_accounts")).filter(F.col("n_accounts") > 1)


@query("distinct_account_types", over(FULL, "select distinct account_type from str_accounts"))
def q_distinct_account_types(spark, sf):
    return structured_full(spark, sf)[0].select("account_type").distinct()


def with_share(counts):
    """Share of the total; the window spans the grouped rows, one per distinct value."""
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


@query("account_type_distribution", over([O.RAW_A], """
select account_type, n, n / sum(n) over () as share
from (select lower(trim(AccountType)) as account_type, count(*) as n from raw_accounts group by 1) t"""))
def q_account_type_distribution(spark, sf):
    counts = T.raw_accounts(spark, sf).groupBy(C.normalize_account_type("AccountType").alias("account_type")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts)


@query("loan_distribution", over(FULL, """
select hasloan, n, n / sum(n) over () as share
from (select hasloan, count(*) as n from str_customers group by hasloan) t"""))
def q_loan_distribution(spark, sf):
    counts = structured_full(spark, sf)[1].groupBy("hasloan").agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts)


@query("quality_flag_counts", over(FULL, "select data_quality_flag, count(*) as n from str_accounts group by 1"))
def q_quality_flag_counts(spark, sf):
    return structured_full(spark, sf)[0].groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- B9, I7, I8

@query("process_stats", over(TWO, """
select count(*) as records_processed,
       count(*) filter (where e.account_id is null) as records_inserted,
       count(*) filter (where e.account_id is not null) as records_updated
from str_accounts_d2 d left join str_accounts_r1 e on d.account_id = e.account_id"""))
def q_process_stats(spark, sf):
    from vaultline.sinks.ledgers import process_stats
    r = two_runs(spark, sf)
    return process_stats(r["acc1"], r["acc_d2"], "account_id")


@query("gate_structured", over(TWO, """
select a.n as new_accounts, c.n as new_customers, (a.n > 0 or c.n > 0) as has_new_data
from (select count(*) as n from raw_accounts r where not exists
        (select 1 from str_accounts_r1 s where s.account_id = trim(cast(r.AccountID as varchar)))) a,
     (select count(*) as n from raw_customers_all r where not exists
        (select 1 from str_customers_r1 s where s.customer_id = trim(cast(r.CustomerID as varchar)))) c"""))
def q_gate_structured(spark, sf):
    from vaultline.plans.gates import structured_gate
    r = two_runs(spark, sf)
    raw_cust = T.raw_customers(spark, sf).unionByName(T.customer_updates(spark, sf))
    return structured_gate(T.raw_accounts(spark, sf), raw_cust, r["acc1"], r["cust1"])


@query("gate_curated", over(TWO, """
select count(*) as new_records, count(*) > 0 as has_new_data from str_accounts_r2 s
where s.account_type = 'savings' and not exists (select 1 from fact_r1 f where f.account_id = s.account_id)"""))
def q_gate_curated(spark, sf):
    from vaultline.plans.gates import curated_gate
    r = two_runs(spark, sf)
    return curated_gate(r["acc2"], r["fact1"])
