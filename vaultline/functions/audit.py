"""Audit-history JSON: keep the first lineage of a row and append one entry per change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTRY = "struct<source_file:string,row_number:string,file_hash:string,ingested_at:string,modified_at:string>"
META = ("struct<source_file:string,row_number:string,file_hash:string,ingested_at:string,"
        f"data_quality_flag:string,history:array<{ENTRY}>>")


def history_entry(source_file, row_number, file_hash, ingested_at, modified_at) -> Column:
    return F.struct(
        F.col(source_file).cast("string").alias("source_file"),
        F.col(row_number).cast("string").alias("row_number"),
        F.col(file_hash).cast("string").alias("file_hash"),
        F.col(ingested_at).cast("string").alias("ingested_at"),
        modified_at.cast("string").alias("modified_at"),
    )


def append_history(existing_meta: Column, new_meta: Column, entry: Column) -> Column:
    """Known row: its stored metadata with ``entry`` appended to ``history``.
    New row: the new metadata with an empty ``history`` list."""
    old = F.from_json(existing_meta, META)
    new = F.from_json(new_meta, META)
    appended = F.concat(F.coalesce(old["history"], F.array().cast(f"array<{ENTRY}>")), F.array(entry))
    kept = old.withField("history", appended)
    fresh = new.withField("history", F.array().cast(f"array<{ENTRY}>"))
    return F.to_json(F.when(existing_meta.isNotNull(), kept).otherwise(fresh), {"ignoreNullFields": "false"})
