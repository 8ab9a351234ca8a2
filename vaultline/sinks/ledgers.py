"""Ledgers: file ingestion, schema versions and process runs, all small Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.operators.incremental import Stored, _meeting


def process_stats(existing: DataFrame | Stored | None, updates: DataFrame, key: str) -> DataFrame:
    """records processed / inserted / updated of one merge (``updates``: stored, unique on the key).

    The target's keys pass a semi-join with the change set's, so a large target is
    counted where it lies; of a ``Stored`` target only the buckets of these keys are read.
    """
    processed = updates.agg(F.count(F.lit(1)).alias("p")).select("p", F.lit(0).cast("bigint").alias("u"))
    if existing is not None:
        known = _meeting(existing, updates, key).select(key).join(updates.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("u"))
        processed = processed.unionByName(known.select(F.lit(0).cast("bigint").alias("p"), "u"))
    return processed.agg(F.sum("p").alias("records_processed"), (F.sum("p") - F.sum("u")).alias("records_inserted"),
                         F.sum("u").alias("records_updated"))


LEDGER_COLUMNS = ("file_id", "file_path", "file_name", "file_type", "file_hash", "file_size_bytes", "row_count",
                  "ingestion_timestamp", "processing_status", "error_message", "modification_time")
LEDGER_SCHEMA = ("file_id string, file_path string, file_name string, file_type string, file_hash string, "
                 "file_size_bytes bigint, row_count bigint, ingestion_timestamp timestamp_ntz, "
                 "processing_status string, error_message string, modification_time timestamp")
PROCESS_SCHEMA = ("run_id string, run_timestamp timestamp_ntz, source_tables string, target_table string, "
                  "records_processed bigint, records_inserted bigint, records_updated bigint, status string, "
                  "duration_seconds double, error_message string")
RESULTS_SCHEMA = ("run_timestamp timestamp_ntz, table_name string, check_name string, column_name string, "
                  "failures bigint, severity string, passed boolean")
SCHEMA_LOG_SCHEMA = ("schema_id string, table_name string, schema_version int, column_definitions string, "
                     "detected_at timestamp_ntz, previous_version_id string, change_description string")


def file_records(files: DataFrame, file_type: str, run_ts_col, status: str = "completed",
                 error: str | Column | None = None, row_counts: DataFrame | None = None) -> DataFrame:
    """Ledger rows for fingerprinted files (path, length, file_hash [, row_count by path]).

    ``error`` is one text for all files or a column of ``files``."""
    df = files
    if row_counts is not None:
        df = df.join(row_counts.select("path", "row_count"), "path", "left")
    else:
        df = df.withColumn("row_count", F.lit(0).cast("bigint"))
    return df.select(
        F.sha2(F.concat_ws("|", F.lit(file_type), "file_hash"), 256).alias("file_id"),
        F.col("path").alias("file_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.lit(file_type).alias("file_type"),
        "file_hash",
        F.col("length").cast("bigint").alias("file_size_bytes"),
        F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
        run_ts_col.alias("ingestion_timestamp"),
        F.lit(status).alias("processing_status"),
        (error if isinstance(error, Column) else F.lit(error)).cast("string").alias("error_message"),
        F.col("modificationTime").alias("modification_time"),
    )


def ledger_upsert(ledger: DataFrame | None, records: DataFrame, update_row_count: bool = True) -> DataFrame:
    """Upsert on (file_type, file_hash): a known file gets the new status, error and timestamp
    (and row count, unless ``update_row_count=False`` for strict parity); identity columns stay."""
    if ledger is None:
        return records.select(*LEDGER_COLUMNS)
    keys = ["file_type", "file_hash"]
    e = ledger.select(*keys, *[F.col(c).alias(f"e_{c}") for c in LEDGER_COLUMNS if c not in keys])
    r = records.select(*keys, *[F.col(c).alias(f"r_{c}") for c in LEDGER_COLUMNS if c not in keys])
    j = e.join(r, keys, "full_outer")
    hit = F.col("r_file_id").isNotNull()
    refreshed = {"processing_status", "error_message", "ingestion_timestamp", "modification_time"}
    if update_row_count:
        refreshed.add("row_count")
    cols = []
    for c in LEDGER_COLUMNS:
        if c in keys:
            cols.append(F.col(c))
        elif c in refreshed:
            cols.append(F.when(hit, F.col(f"r_{c}")).otherwise(F.col(f"e_{c}")).alias(c))
        else:
            cols.append(F.coalesce(F.col(f"e_{c}"), F.col(f"r_{c}")).alias(c))
    return j.select(*cols)


def process_row(stats: DataFrame, run_ts_col, sources: str, target: str, status: str = "completed",
                seconds: float = 0.0, error: str | None = None) -> DataFrame:
    """One row of the process log from one row of merge statistics."""
    return stats.select(
        F.sha2(F.concat_ws("|", run_ts_col.cast("string"), F.lit(target)), 256).alias("run_id"),
        run_ts_col.alias("run_timestamp"), F.lit(sources).alias("source_tables"), F.lit(target).alias("target_table"),
        "records_processed", "records_inserted", "records_updated", F.lit(status).alias("status"),
        F.lit(float(seconds)).alias("duration_seconds"), F.lit(error).cast("string").alias("error_message"))


def check_rows(results: DataFrame, run_ts_col) -> DataFrame:
    """Check results as rows of the stored results table."""
    return results.select(run_ts_col.alias("run_timestamp"), "table_name", "check_name", "column_name", "failures",
                          "severity", "passed")


def ledger_report(ledger: DataFrame) -> DataFrame:
    """Ingestion history, newest first."""
    return ledger.select("file_name", "file_type", "processing_status", "row_count", "ingestion_timestamp",
                         "error_message").orderBy(F.col("ingestion_timestamp").desc(), "file_name")


def schema_report(log: DataFrame) -> DataFrame:
    """Schema versions, by table, newest first."""
    return log.select("table_name", "schema_version", "detected_at", "change_description", "column_definitions") \
        .orderBy("table_name", F.col("schema_version").desc())


def process_report(log: DataFrame) -> DataFrame:
    """Process runs, newest first."""
    return log.select("run_timestamp", "target_table", "source_tables", "records_processed", "records_inserted",
                      "records_updated", "status", "duration_seconds", "error_message") \
        .orderBy(F.col("run_timestamp").desc(), "target_table")
