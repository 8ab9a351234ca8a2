"""Incremental building blocks: watermark, new-or-newer, created-date carry-over, upsert.

An incremental model returns the *change set*; ``upsert`` folds it into the
existing table state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1900-01-01 00:00:00"


@dataclass(frozen=True)
class Stored:
    """A stored target: all its rows, and of a table laid out by key those that a change set's keys can meet.

    ``matching(changes, key)`` reads the buckets of these keys only; rows of other keys
    may be among them, rows of these keys are all there.
    """

    rows: DataFrame
    matching: Callable[[DataFrame, str], DataFrame]


def _all(existing: DataFrame | Stored | None) -> DataFrame | None:
    return existing.rows if isinstance(existing, Stored) else existing


def _meeting(existing: DataFrame | Stored, changes: DataFrame, key: str) -> DataFrame:
    return existing.matching(changes, key) if isinstance(existing, Stored) else existing


def _ntz(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if value is None:
        return F.localtimestamp()
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def watermark_value(existing: DataFrame | Stored | None, target_ts: str):
    """``coalesce(max(target_ts), 1900-01-01)`` of the target, read once on the driver.

    One scalar comes back; passing it on as a literal lets the source filter reach
    the Parquet scan (row-group pruning on an append-only, time-ordered raw table).
    """
    if existing is None:
        return None
    row = _all(existing).select(F.coalesce(F.max(F.col(target_ts).cast("timestamp_ntz")),
                                     F.lit(EPOCH).cast("timestamp_ntz")).cast("string").alias("w")).first()
    return row["w"]


def since_watermark(source: DataFrame, source_ts: str, existing: DataFrame | Stored | None, target_ts: str,
                    partition_col: str = "_ingest_date") -> DataFrame:
    """Rows strictly newer than the target's watermark; rows at or before it are late and ignored.

    When the source is partitioned by the date of ``source_ts`` (raw tables are), the
    watermark also becomes a partition predicate, so older partitions are pruned.
    """
    mark = watermark_value(existing, target_ts)
    if mark is None:
        return source
    out = source.filter(F.col(source_ts).cast("timestamp_ntz") > F.lit(mark).cast("timestamp_ntz"))
    if partition_col in source.columns:
        out = out.filter(F.col(partition_col) >= F.to_date(F.lit(mark).cast("timestamp_ntz")))
    return out


def new_or_newer(source: DataFrame, existing: DataFrame | Stored | None, key: str, ts: str) -> DataFrame:
    """Source rows whose key is absent from the target, or whose ``ts`` is newer than the target's.

    Of a ``Stored`` target only the buckets of the source's keys are read.
    """
    if existing is None:
        return source
    touched = _meeting(existing, source, key).select(key, ts).join(source.select(key), key, "left_semi")
    e = touched.select(F.col(key).alias("_e_key"), F.col(ts).cast("timestamp_ntz").alias("_e_ts"))
    joined = source.join(e, source[key] == e["_e_key"], "left")
    keep = F.col("_e_key").isNull() | (
        F.col(ts).cast("timestamp_ntz") > F.coalesce(F.col("_e_ts"), F.lit(EPOCH).cast("timestamp_ntz"))
    )
    return joined.filter(keep).drop("_e_key", "_e_ts")


def preserve_created(updates: DataFrame, existing: DataFrame | Stored | None, key: str, run_ts=None,
                     column: str = "created_date") -> DataFrame:
    """Add ``created_date``: the target's value for a known key, else the run timestamp.

    ``updates`` is read twice, so pass a stored change set. Its bytes are then known,
    and under the broadcast threshold the target is streamed through a semi-join with
    its keys and never shuffled; of a ``Stored`` target only their buckets are read.
    """
    now = _ntz(run_ts)
    if existing is None:
        return updates.withColumn(column, now)
    touched = _meeting(existing, updates, key).join(updates.select(key), key, "left_semi")
    e = touched.select(F.col(key).alias("_c_key"), F.col(column).cast("timestamp_ntz").alias("_c_created"))
    return (updates.join(e, updates[key] == e["_c_key"], "left")
            .withColumn(column, F.coalesce(F.col("_c_created"), now))
            .drop("_c_key", "_c_created"))


def upsert(existing: DataFrame | None, updates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Merge by unique key: matched rows are replaced, unmatched inserted (SCD type 1).

    ``updates`` must be unique on the key (models deduplicate first). NULL keys never
    match. A stored change set under the broadcast threshold leaves the target unshuffled.
    """
    if existing is None:
        return updates
    keys = [key] if isinstance(key, str) else list(key)
    kept = existing.join(updates.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(updates.select(*existing.columns), allowMissingColumns=False)


def has_new(source: DataFrame, target: DataFrame | None, source_key: Column, target_key: str) -> DataFrame:
    """Rows of ``source`` whose computed key has no match in ``target`` (NOT EXISTS)."""
    if target is None:
        return source
    t = target.select(F.col(target_key).alias("_t_key"))
    return source.join(t, source_key == t["_t_key"], "left_anti")


def new_keys(source: DataFrame, target: DataFrame | None, source_key: Column, target_key: str) -> DataFrame:
    """Distinct keys (``key``) of ``source`` that ``target`` lacks.

    The history is reduced to its distinct keys first (combined before the shuffle), so
    a key with many versions is one row of the anti-join.
    """
    keys = source.select(source_key.alias("key")).where("key is not null").distinct()
    if target is None:
        return keys
    return keys.join(target.select(F.col(target_key).alias("key")), "key", "left_anti")
