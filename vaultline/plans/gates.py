"""Skip-if-no-new-data gates (structured and curated).

The gates count pending rows with anti-joins. ``mode="new_keys"`` mirrors the
reference (only keys absent from the target count); the driver-side decision
uses ``limit(1)`` so a gate stops at the first pending row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.operators.incremental import has_new


def _count(df: DataFrame, alias: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def structured_gate(raw_accounts: DataFrame, raw_customers: DataFrame,
                    str_accounts: DataFrame | None, str_customers: DataFrame | None) -> DataFrame:
    na = _count(has_new(raw_accounts, str_accounts, F.trim(raw_accounts["AccountID"]), "account_id"), "new_accounts")
    nc = _count(has_new(raw_customers, str_customers, F.trim(raw_customers["CustomerID"]), "customer_id"),
                "new_customers")
    # Two one-row counts combined by one more aggregate (no cartesian product).
    both = na.select(F.col("new_accounts").alias("n"), F.lit("a").alias("k")) \
        .unionByName(nc.select(F.col("new_customers").alias("n"), F.lit("c").alias("k")))
    return both.agg(F.max(F.when(F.col("k") == "a", F.col("n"))).alias("new_accounts"),
                    F.max(F.when(F.col("k") == "c", F.col("n"))).alias("new_customers")) \
        .withColumn("has_new_data", (F.col("new_accounts") > 0) | (F.col("new_customers") > 0))


def curated_gate(str_accounts: DataFrame, fact: DataFrame | None) -> DataFrame:
    sav = str_accounts.filter(F.col("account_type") == "savings")
    n = _count(has_new(sav, fact, sav["account_id"], "account_id"), "new_records")
    return n.withColumn("has_new_data", F.col("new_records") > 0)


def any_pending(pending: DataFrame) -> bool:
    """Driver-side gate decision: stops at the first pending row."""
    return pending.limit(1).count() > 0


def pair_gate(ledger: DataFrame | None, since=None) -> DataFrame:
    """Both sources have a completed file (ingested after ``since``): one row
    (accounts_ready, customers_ready, ready). The structured run waits for the pair."""
    from vaultline.operators.incremental import _ntz
    if ledger is None:
        return None
    done = ledger.filter(F.col("processing_status") == "completed")
    if since is not None:
        done = done.filter(F.col("ingestion_timestamp") > _ntz(since))
    return done.agg(
        (F.count_if(F.col("file_type") == "accounts") > 0).alias("accounts_ready"),
        (F.count_if(F.col("file_type") == "customers") > 0).alias("customers_ready"),
    ).withColumn("ready", F.col("accounts_ready") & F.col("customers_ready"))


PAIR_SIDES = ("accounts", "customers")


def newest_files(ledger: DataFrame) -> DataFrame:
    """(file_type, modified): the newest completed file of each source."""
    return (ledger.filter((F.col("processing_status") == "completed") & F.col("file_type").isin(*PAIR_SIDES))
            .groupBy("file_type").agg(F.max("modification_time").alias("modified")))


def pair_triggers(arrivals: DataFrame) -> DataFrame:
    """Arrivals (poll, file_type, modified) -> (poll, accounts_modified, customers_modified, fires), one row a poll.

    A poll fires when both sources have a file and the pair of their newest ones is not
    the pair of the poll before. Files are reduced to one row a poll first, so the
    window over all polls sees no files.
    """
    newest = [F.max(F.when(F.col("file_type") == s, F.col("modified"))).alias(f"{s}_modified") for s in PAIR_SIDES]
    polls = arrivals.groupBy("poll").agg(*newest)
    so_far = Window.orderBy("poll").rowsBetween(Window.unboundedPreceding, 0)
    polls = polls.select("poll", *[F.max(f"{s}_modified").over(so_far).alias(f"{s}_modified") for s in PAIR_SIDES])
    pair = F.struct(*[f"{s}_modified" for s in PAIR_SIDES])
    both = F.col("accounts_modified").isNotNull() & F.col("customers_modified").isNotNull()
    return polls.withColumn("fires", both & ~pair.eqNullSafe(F.lag(pair).over(Window.orderBy("poll"))))
