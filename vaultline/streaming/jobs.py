"""Streaming ingestion and exactly-once upserts with ``foreachBatch``.

The file-source checkpoint is the arrival cursor (each file is offered once);
``trigger(availableNow=True)`` drains what has landed and stops, a
``processingTime="60 seconds"`` trigger polls. ``foreachBatch`` is at-least-once:
ingestion skips files whose rows are stored, and merged tables commit the last batch of
every stream with the version and skip its replays.

Files may arrive in any order, so the streamed upsert keeps, per key, the newest of
stored and incoming rows instead of the batch path's strict watermark.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vaultline.operators.dedupe import keep_latest
from vaultline.operators.incremental import _ntz
from vaultline.plans import models as M
from vaultline.plans.gates import PAIR_SIDES, newest_files
from vaultline.plans.ingest import Catalog, Source, ingest_files
from vaultline.session import materialize
from vaultline.sinks.tables import TASK_BYTES, CommitConflict, Newest, VersionedTable, _FS

# Merges tried on top of other writers' commits.
MERGE_TRIES = 10
# Seconds after which another stream's call for a pair counts as dead.
CLAIM_SECONDS = 6 * 3600
# Spark's file stream passes over files this much older than the newest it has seen (a week unless told
# otherwise), and remembers the names of younger ones.
MAX_FILE_AGE = "3650d"
LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def _trigger(writer, trigger: str):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def ingest_batch(spark: SparkSession, catalog: Catalog, source: Source, arrived: DataFrame, run_ts) -> dict:
    """One micro-batch of arrived files (path, length, modificationTime); a replay adds nothing."""
    return ingest_files(spark, catalog, source, materialize(arrived.select("path", "length", "modificationTime"), "arrived"), run_ts)


def fire_pair(spark: SparkSession, catalog: Catalog, newest: DataFrame, writer: tuple[str, int],
              on_pair: Callable[[dict], None]) -> dict | None:
    """Call ``on_pair`` once for a pair of newest files (file_type, modified) that has not fired; returns the pair.

    The pair's row in the catalog's pair log is the cursor: it is claimed before the call
    and marked done after it. A claim that is done, or that another stream has held for
    less than ``CLAIM_SECONDS``, is left alone; a claim of the same stream is a call that
    died, and is made again, as is an older claim of a stream that never came back.
    """
    found = {r.file_type: r.modified for r in newest.collect()}
    if set(found) != set(PAIR_SIDES) or None in found.values():
        return None
    log, (stream, batch) = catalog.pair_log(spark), writer
    sides = [F.lit(found[s].isoformat(sep=" ")).cast("timestamp_ntz").alias(f"{s}_modified") for s in PAIR_SIDES]
    row = spark.range(1).select(F.lit("_".join(found[s].isoformat() for s in PAIR_SIDES)).alias("pair_id"), *sides,
                                F.lit(stream).alias("stream"), F.lit(batch).cast("bigint").alias("batch"), F.lit("started").alias("status"),
                                F.unix_timestamp().alias("claimed_at"))
    for _ in range(MERGE_TRIES):
        base = log.version()
        known = log.read(base)
        held = known.join(row.select("pair_id"), "pair_id", "left_semi").select(
            "stream", "status", (F.unix_timestamp() - F.col("claimed_at")).alias("age")).first() if known is not None else None
        if held is not None and (held.status == "done" or (held.stream != stream and held.age < CLAIM_SECONDS)):
            return None
        try:
            log.upsert(materialize(row, "pair"), "pair_id", base=base)
            break
        except CommitConflict:
            continue
    else:
        raise CommitConflict(f"the pair log {log.path} is changed by too many writers")
    on_pair(found)
    done = materialize(row.withColumn("status", F.lit("done")), "pair")
    for last in range(MERGE_TRIES):
        try:
            log.upsert(done, "pair_id")
            return found
        except CommitConflict:
            if last == MERGE_TRIES - 1:
                raise


def _arrivals(spark: SparkSession, landing_dir: str, max_files_per_trigger: int) -> DataFrame:
    """File names as a stream: path, length, modificationTime; files that kept an old time when they arrived as well."""
    return (spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files_per_trigger).option("maxFileAge", MAX_FILE_AGE)
            .load(landing_dir).select("path", "length", "modificationTime"))


def watch_pairs(spark: SparkSession, catalog: Catalog, accounts_dir: str, customers_dir: str, checkpoint: str,
                on_pair: Callable[[dict], None], trigger: str = "availableNow", max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Watch both landing folders and call ``on_pair`` once per new pair of newest files.

    One stream over both sources: a micro-batch is a poll. The newest file of each side
    is kept in the catalog (two rows), merged once per batch, so neither a batch with one
    side only, nor files that are older than the newest, nor a replay fires anything.
    """
    sides = zip(PAIR_SIDES, (accounts_dir, customers_dir))
    files = [_arrivals(spark, d, max_files_per_trigger).select(F.lit(s).alias("file_type"), F.col("modificationTime").cast("timestamp_ntz").alias("modified"))
             for s, d in sides]

    def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
        return stored.unionByName(new).groupBy("file_type").agg(F.max("modified").alias("modified"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        writer, state = (_stream_of(spark, checkpoint), batch_id), catalog.newest_files(spark)
        arrived = materialize(batch.groupBy("file_type").agg(F.max("modified").alias("modified")), "arrived")
        state.upsert(arrived, "file_type", writer=writer, merge=merge)
        fire_pair(spark, catalog, state.read(), writer, on_pair)

    both = files[0].unionByName(files[1])
    return _trigger(both.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), trigger).start()


def ingest_stream(spark: SparkSession, catalog: Catalog, source: Source, landing_dir: str, checkpoint: str,
                  trigger: str = "availableNow", max_files_per_trigger: int = 1000,
                  run_ts_of_batch: Callable[[int], str] | None = None,
                  on_pair: Callable[[dict], None] | None = None) -> StreamingQuery:
    """Landing files → raw table under the rules of batch ingestion (ledger, hashes, headers, drift).

    The stream carries file names only. ``on_pair`` is called once per new pair of the
    newest completed files of both sources, whichever source's stream completes it.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(spark, catalog, source, batch, run_ts_of_batch(batch_id) if run_ts_of_batch else None)
        ledger = catalog.ledger(spark).read() if on_pair else None
        if ledger is not None:
            newest = newest_files(ledger).withColumn("modified", F.col("modified").cast("timestamp_ntz"))
            fire_pair(spark, catalog, newest, (_stream_of(spark, checkpoint), batch_id), on_pair)

    arrived = _arrivals(spark, landing_dir, max_files_per_trigger)
    return _trigger(arrived.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), trigger).start()


@dataclass(frozen=True)
class StreamedModel:
    """A structured model as a stream: cleansing, key, and its audit columns."""

    key: str
    clean: Callable[[DataFrame], DataFrame]
    audit: Callable[..., DataFrame]
    columns: tuple


ACCOUNTS = StreamedModel("account_id", M.clean_accounts, M.audit_accounts, M.STR_ACCOUNT_COLUMNS)
CUSTOMERS = StreamedModel("customer_id", M.clean_customers, M.audit_customers, M.STR_CUSTOMER_COLUMNS)


# The order of ``latest_first``, read from a structured row's lineage.
NEWEST = Newest(("_last_processed_at", "CAST(get_json_object(metadata_json, '$.row_number') AS BIGINT)",
                 "get_json_object(metadata_json, '$.file_hash')"), first="created_date")


def _late_apart(table: VersionedTable, raw: DataFrame, writer: tuple[str, int], late: VersionedTable) -> tuple[DataFrame, str | None]:
    """The batch's rows newer than the table's event-time mark, and the mark; the others go to ``late``, once."""
    mark = table.commit_info().get("mark")
    if mark is None:
        return raw, None
    newer = F.coalesce(F.col("_ingested_at").cast("timestamp_ntz") > F.lit(mark).cast("timestamp_ntz"), F.lit(False))
    rows = materialize(raw.where(~newer).withColumn("_late_after", F.lit(mark).cast("timestamp_ntz")), "late")
    if not rows.isEmpty():
        late.append(rows, writer=writer)
    return raw.where(newer), mark


def _plan_bytes(df: DataFrame) -> int:
    """Bytes of a frame as Spark estimates them: of stored files what they hold, more than any table where it does not know."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def upsert_batch(table: VersionedTable, model: StreamedModel, raw: DataFrame, writer: tuple[str, int], run_ts=None,
                 late: VersionedTable | None = None) -> int | None:
    """Merge one micro-batch of raw rows into a structured table, whatever the order of arrival.

    The batch is reduced to one row a key and put beside the table, or merged into it with
    those before it once they are a share of it (``Newest``); the newest row a key stays with
    the ``created_date`` that is stored. ``writer`` is (stream, batch): a replay by the same
    stream is skipped; after another writer's commit the merge is done again on top of it.

    With a ``late`` table the batch path's strict rule holds: the event-time mark (the
    newest row merged so far) is committed with the table, and rows at or before it are
    not merged but put into ``late``, with the mark they missed.
    """
    mark = None
    if late is not None:
        if table.has_batch(writer):
            return None
        raw, mark = _late_apart(table, raw, writer, late)
    if _plan_bytes(raw) <= TASK_BYTES:
        raw = raw.coalesce(1)  # one task's rows need no shuffle
    latest = keep_latest(model.clean(raw), [model.key], M.latest_first())
    changes = model.audit(latest.withColumn("created_date", _ntz(run_ts)), run_ts)

    info = {}
    if late is not None:
        changes = materialize(changes, "stream_changes")
        newest = changes.agg(F.max("_last_processed_at").cast("string")).first()[0]
        info["mark"] = max(filter(None, (mark, newest)), default=None)
    for _ in range(MERGE_TRIES - 1):
        try:
            return table.upsert(changes, model.key, writer=writer, merge=NEWEST, **info)
        except CommitConflict:
            continue
    return table.upsert(changes, model.key, writer=writer, merge=NEWEST, **info)


def _stream_of(spark: SparkSession, checkpoint: str) -> str:
    """The id under which Spark keeps a query in its checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(_FS(spark, checkpoint).read_text("metadata"))["id"]


def stream_structured(spark: SparkSession, model: StreamedModel, raw_path: str, table_path: str, checkpoint: str,
                      raw_schema: StructType, trigger: str = "availableNow", max_files_per_trigger: int = 1000,
                      run_ts_of_batch: Callable[[int], str] | None = None, late_path: str | None = None) -> StreamingQuery:
    """Raw rows (Parquet, append-only) → structured table with the batch model's columns, merged per micro-batch.

    Several streams may write one table, and a stream may start again from a new
    checkpoint: it then offers rows again, which changes nothing. Rows may be late by
    any time; with ``late_path`` the strict rule holds instead (``upsert_batch``), for
    one stream a table.
    """
    table = VersionedTable(spark, table_path)
    late = VersionedTable(spark, late_path) if late_path else None
    stream = spark.readStream.schema(raw_schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(raw_path)
    stream_id = cache(lambda: _stream_of(spark, checkpoint))  # there once the query runs

    def sink(batch: DataFrame, batch_id: int) -> None:
        run_ts = run_ts_of_batch(batch_id) if run_ts_of_batch else None
        upsert_batch(table, model, batch, (stream_id(), batch_id), run_ts, late)

    return _trigger(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint), trigger).start()
