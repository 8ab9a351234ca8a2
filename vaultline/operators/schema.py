"""Schema detection and drift tracking for landing files.

Types follow the reference's CSV reader (pandas) rules, computed in ONE
aggregate pass over the text columns instead of a second inference scan:
``int64`` (all values integers, no NULL), ``float64`` (all numeric, or all
NULL), ``bool`` (only True/False spellings, no NULL), else ``object``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFS_SCHEMA = "array<struct<name:string,type:string,nullable:boolean>>"
INT_PATTERN = r"^\s*[-+]?[0-9]+\s*$"
# What the CSV reader takes for a number: digits with at most one point and an exponent, or a name of infinity.
NUMBER_PATTERN = r"^\s*[-+]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
# Boolean spellings the CSV reader turns into a bool column.
BOOL_WORDS = ("True", "False", "TRUE", "FALSE", "true", "false")


def detect_schema(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(ordinal, name, type, nullable) per column, from one aggregate over the data."""
    cols = list(columns or [c for c in df.columns if not c.startswith("_")])
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("string")
        aggs += [
            F.max(v.isNull()).alias(f"n{i}"),
            F.count(v).alias(f"k{i}"),
            F.count_if(v.isNotNull() & ~v.rlike(INT_PATTERN)).alias(f"i{i}"),
            F.count_if(v.isNotNull() & ~v.rlike(NUMBER_PATTERN)).alias(f"d{i}"),
            F.count_if(v.isNotNull() & ~v.isin(*BOOL_WORDS)).alias(f"b{i}"),
        ]
    wide = df.agg(*aggs)
    entries = []
    for i, c in enumerate(cols):
        has_null = F.coalesce(F.col(f"n{i}"), F.lit(False))
        dtype = (F.when(F.col(f"k{i}") == 0, F.lit("float64"))
                 .when((F.col(f"i{i}") == 0) & ~has_null, F.lit("int64"))
                 .when(F.col(f"d{i}") == 0, F.lit("float64"))
                 .when((F.col(f"b{i}") == 0) & ~has_null, F.lit("bool"))
                 .otherwise(F.lit("object")))
        entries.append(F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("name"), dtype.alias("type"),
                                has_null.alias("nullable")))
    return wide.select(F.inline(F.array(*entries)))


def schema_json(schema: DataFrame, table_name: str) -> DataFrame:
    """One row (table_name, column_definitions) with a JSON list in column order."""
    ordered = F.sort_array(F.collect_list(F.struct("ordinal", "name", "type", "nullable")))
    defs = F.transform(ordered, lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"),
                                                   x["nullable"].alias("nullable")))
    return schema.agg(F.to_json(defs).alias("column_definitions")) \
        .select(F.lit(table_name).alias("table_name"), "column_definitions")


def _shape(defs, compare_nullable: bool):
    parsed = F.from_json(defs, DEFS_SCHEMA)
    if compare_nullable:
        return F.to_json(parsed)
    return F.to_json(F.transform(parsed, lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))))


def schema_drift(current: DataFrame, log: DataFrame | None, compare_nullable: bool = False) -> DataFrame:
    """Compare the current schema row with the table's latest logged version.

    Returns one row: table_name, column_definitions, changed, schema_version (new
    version if changed, else the current one), previous_version_id,
    change_description. By default names and types are compared, not the
    data-dependent nullable flag.
    """
    cur = current.select("table_name", "column_definitions", F.lit(None).cast("string").alias("schema_id"),
                         F.lit(None).cast("int").alias("schema_version"), F.lit("current").alias("side"))
    if log is not None:
        prev = log.select("table_name", "column_definitions", "schema_id",
                          F.col("schema_version").cast("int").alias("schema_version"), F.lit("log").alias("side"))
        cur = cur.unionByName(prev)
    latest = F.max_by(F.struct("schema_id", "schema_version", "column_definitions"),
                      F.when(F.col("side") == "log", F.col("schema_version")))
    g = cur.groupBy("table_name").agg(
        F.max(F.when(F.col("side") == "current", F.col("column_definitions"))).alias("column_definitions"),
        latest.alias("last")).where("column_definitions is not null")  # tables that are being compared
    last_v = F.col("last.schema_version")
    changed = last_v.isNull() | (_shape(F.col("column_definitions"), compare_nullable)
                                 != _shape(F.col("last.column_definitions"), compare_nullable))
    return g.select(
        "table_name", "column_definitions",
        changed.alias("changed"),
        F.when(last_v.isNull(), F.lit(1)).when(changed, last_v + 1).otherwise(last_v).alias("schema_version"),
        F.col("last.schema_id").alias("previous_version_id"),
        F.when(last_v.isNull(), F.lit("Initial schema")).when(changed, F.lit("Schema change detected"))
        .alias("change_description"),
    )


def schema_log_rows(drift: DataFrame, run_ts_col) -> DataFrame:
    """Log rows to append for changed schemas (empty when nothing changed)."""
    return drift.filter("changed").select(
        F.sha2(F.concat_ws("|", "table_name", F.col("schema_version").cast("string"), "column_definitions"), 256)
        .alias("schema_id"),
        "table_name", F.col("schema_version").cast("int").alias("schema_version"), "column_definitions",
        run_ts_col.alias("detected_at"), "previous_version_id", "change_description")


def latest_versions(log: DataFrame) -> DataFrame:
    """Latest logged version per table."""
    return log.groupBy("table_name").agg(
        F.max_by(F.struct("schema_id", "schema_version", "column_definitions", "detected_at"), "schema_version")
        .alias("v")).select("table_name", "v.*")
