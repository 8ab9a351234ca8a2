"""Raw-layer ingestion job: landing CSV → append-only raw table with lineage,
file ledger and schema-version log.

Order of work: examine files not yet completed (hash, header) → skip known hashes →
per header layout scan, row numbers, write rows → schema drift and log → ledger.

Bad files stop nobody: a file that cannot be read, or whose header lacks a column, is
``failed`` in the ledger with its own error, and the others go on; a file that fails
while its layout is loaded is taken out and the rest of the layout loaded again. Records
with more fields than their header go to the rejects table (file, row number, text).
Only an error that no file causes is raised, after the files it hit are recorded.

A large file is a raw partition named by its hash; small ones share one, up to
``PACK_BYTES``, named in a manifest before the rows are written. A part appears whole or
not at all, so a retry after any failure, or a replayed micro-batch, finds the rows that
are there already and writes none twice. Batch and streaming ingestion run the same function.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultline.operators.incremental import _ntz
from vaultline.operators.schema import detect_schema, schema_drift, schema_json, schema_log_rows
from vaultline.session import materialize
from vaultline.sinks.ledgers import file_records, ledger_upsert
from vaultline.sinks.tables import VersionedTable, append_raw, stored_files
from vaultline.sources import landing as L

LEDGER_KEY = ("file_type", "file_hash")
# Files ingested at once (their paths are on the driver), and bytes up to which files share a raw part.
SLICE_FILES, PACK_BYTES = 10_000, 64 << 20
# Landing bytes that a task writes: it sorts its rows by part, and they take many times these bytes in memory.
TASK_BYTES = 16 << 20


@dataclass(frozen=True)
class Source:
    file_type: str           # "accounts" / "customers"
    table_name: str          # raw table name
    columns: tuple
    aliases: dict


ACCOUNTS = Source("accounts", "raw_accounts", L.ACCOUNT_COLUMNS, L.ACCOUNT_ALIASES)
CUSTOMERS = Source("customers", "raw_customers", L.CUSTOMER_COLUMNS, L.CUSTOMER_ALIASES)


@dataclass
class Catalog:
    """Where a deployment keeps its tables (path prefixes per layer)."""
    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def table(self, spark: SparkSession, layer: str, name: str) -> VersionedTable:
        return VersionedTable(spark, f"{self.root}/{layer}/{name}")

    def rejects(self, name: str) -> str:
        return f"{self.root}/raw/{name}_rejects"

    def manifest(self, spark: SparkSession, name: str) -> VersionedTable:
        return self.table(spark, "raw", f"{name}_packs")

    def ledger(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "raw", "file_ingestion_metadata")

    def newest_files(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "raw", "newest_files")

    def pair_log(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "raw", "pair_log")

    def schema_log(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "raw", "schema_version_tracking")

    def process_log(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "curated", "process_metadata")

    def check_results(self, spark: SparkSession) -> VersionedTable:
        return self.table(spark, "curated", "check_results")


def ingest(spark: SparkSession, catalog: Catalog, source: Source, landing_dir: str, run_ts,
           mode: str = "latest", source_name=None) -> dict:
    """Ingest landing files of one source (``latest``: the newest, ``all_unseen``: every
    file not completed). Returns a small status dict."""
    listing = L.list_landing(spark, landing_dir)
    if mode == "latest":
        listing = L.latest_file(listing)
    return ingest_files(spark, catalog, source, listing, run_ts, source_name)


def ingest_files(spark: SparkSession, catalog: Catalog, source: Source, listing: DataFrame, run_ts,
                 source_name=None) -> dict:
    """Ingest the listed files (path, length, modificationTime) that are not completed yet.

    Returns ``status`` (``completed``, ``partial``, ``failed`` or ``skipped``), ``files``
    loaded, ``failed`` ones and ``rejected`` records.
    """
    # Only files not already completed under the same (path, size, mtime) are examined;
    # their paths reach the driver a slice at a time.
    fresh = materialize(L.unseen(listing, catalog.ledger(spark).read(), source.file_type).select("path"), "fresh")
    total, paths = {"files": 0, "failed": 0, "rejected": 0}, []
    for row in fresh.toLocalIterator():
        paths.append(row.path)
        if len(paths) == SLICE_FILES:
            total |= _add(total, _Slice(spark, catalog, source, run_ts, source_name).ingest(paths))
            paths = []
    if paths:
        total |= _add(total, _Slice(spark, catalog, source, run_ts, source_name).ingest(paths))
    status = ("partial" if total["failed"] else "completed") if total["files"] else ("failed" if total["failed"] else "skipped")
    return {"status": status, **total}


def _add(total: dict, more: dict) -> dict:
    return {k: v if k == "schema_version" else v + total[k] for k, v in more.items()}


class _Slice:
    """The ingestion of one slice of files."""

    def __init__(self, spark, catalog: Catalog, source: Source, run_ts, source_name):
        self.spark, self.catalog, self.source, self.run_ts, self.source_name = spark, catalog, source, run_ts, source_name
        self.raw, self.ledger, self.ts = catalog.raw(source.table_name), catalog.ledger(spark), _ntz(run_ts)

    def ingest(self, paths: list[str]) -> dict:
        examined = materialize(L.fingerprint(self.spark, paths), "examined")
        known = L.unprocessed(examined.where("error is null"), self.ledger.read(), self.source.file_type)
        # the same bytes delivered under several names are one file
        first = F.min(F.struct("path", "length", "modificationTime", "header", "quoted_newline", "regular_quotes"))
        pending = materialize(known.groupBy("file_hash").agg(first.alias("f")).select("f.*", "file_hash"), "pending")

        layouts = pending.groupBy("header", "quoted_newline", (F.col("length") < PACK_BYTES).alias("small")).count().collect()
        errors = {tuple(r.header): e for r in layouts if (e := L.header_error(r.header, self.source.columns, self.source.aliases))}
        unread = examined.where("error is not null").withColumn("file_hash", F.md5(F.concat(F.lit("unreadable "), "path")))
        failed = 0 if unread.isEmpty() else self._fail(unread, F.col("error"))
        for header, error in errors.items():
            failed += self._fail(pending.where(_has_header(header)), error)
        done, rejected, broken = [], 0, None
        for r in layouts:
            if tuple(r.header) in errors:
                continue
            files = pending.where(_has_header(r.header) & (F.col("quoted_newline") == r.quoted_newline) & ((F.col("length") < PACK_BYTES) == r.small))
            try:
                loaded, bad = self._load_without_bad(materialize(files, "unit"), r.small)
            except Exception as exc:
                failed += self._fail(files, str(exc))
                broken = broken or exc
                continue
            failed += bad
            if loaded:
                done.append(loaded)
                rejected += loaded[3]
        out = {"files": 0, "failed": failed, "rejected": rejected}
        if done:
            files = reduce(DataFrame.unionByName, [d[0] for d in done])
            try:
                out |= {"schema_version": self._log_schema([d[1] for d in done])}
                counts = L.file_row_counts(reduce(DataFrame.unionByName, [d[2] for d in done]))
                out["files"] = self._record(files, "completed", None, counts)
            except Exception as exc:
                self._fail(files, str(exc))
                raise
        if broken:
            raise broken
        return out

    def _load_without_bad(self, files: DataFrame, small: bool):
        """Load files of one layout; those that an error names are failed and taken out."""
        failed = 0
        while True:
            try:
                return self._load(files, small), failed
            except Exception as exc:
                text = str(exc)
                named = [r.path for r in files.select("path").collect() if r.path.rpartition("/")[2] in text]
                if not named:
                    raise
                failed += self._fail(files.where(F.col("path").isin(named)), text)
                files = materialize(files.where(~F.col("path").isin(named)), "unit")
                if files.isEmpty():
                    return None, failed

    def _load(self, files: DataFrame, small: bool):
        """Rows and rejects of files into their tables: (files, scan, blocks, rejected)."""
        scanned = L.scan_csv(self.spark, [], self.source.columns, self.source.aliases, keep_extra=True, files=files, keep_rejects=True)
        blocks = L.block_table(scanned)
        manifest = self.catalog.manifest(self.spark, self.source.table_name)
        missing = files.join(stored_files(self.spark, self.raw, manifest.read()), "file_hash", "left_anti")
        missing = missing.select(F.col("file_hash").alias("_file_hash"), "length")
        if small:
            missing = materialize(self._packed(missing), "packed")
            tasks = self._tasks(missing)
            packs = missing.where("_pack is not null").select(F.col("_pack").alias("pack"), F.col("_file_hash").alias("file_hash"))
            if not packs.isEmpty():
                manifest.append(packs)
        else:
            missing = missing.withColumn("_pack", F.lit(None).cast("string"))
        rows = L.with_lineage(scanned, files, self.run_ts, self.source_name, blocks).join(missing.drop("length"), "_file_hash")
        if small:  # few bytes a part: a few tasks write a part, instead of every task a piece of every part
            parts, pieces = tasks
            piece = F.pmod(F.xxhash64("_file_hash", "_row_number"), F.lit(pieces))
            rows = rows.repartitionById(parts * pieces, (F.col("_number") * pieces + piece).cast("int")).drop("_number")
        append_raw(rows.where("_reject is null").drop("_reject"), self.raw)
        rejected = int(blocks.agg(F.coalesce(F.sum("_bad"), F.lit(0))).first()[0])
        if rejected:
            bad = rows.where("_reject is not null").select(F.col("_reject").alias("record"), "_source_file", "_file_hash", "_row_number",
                                                           "_ingested_at", "_pack")
            append_raw(bad, self.catalog.rejects(self.source.table_name))
        return files, scanned, blocks, rejected

    @staticmethod
    def _tasks(packed: DataFrame) -> tuple[int, int]:
        """Number of parts, and of tasks that write the largest of them."""
        sizes = packed.groupBy("_number").agg(F.sum("length").alias("bytes")).agg(F.max("_number").alias("last"), F.max("bytes").alias("bytes")).first()
        return int(sizes["last"] or 0) + 1, max(1, -(-(sizes["bytes"] or 0) // TASK_BYTES))

    @staticmethod
    def _packed(files: DataFrame) -> DataFrame:
        """Files with ``_number``, their part, and ``_pack``, null for one that fills a part by itself; at most
        ``SLICE_FILES`` files pass the window."""
        before = Window.orderBy("_file_hash").rowsBetween(Window.unboundedPreceding, -1)
        number = F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / F.lit(PACK_BYTES))
        placed = files.withColumn("_number", number).withColumn("_count", F.count(F.lit(1)).over(Window.partitionBy("_number")))
        name = F.concat(F.lit(f"p{uuid.uuid4().hex}-"), F.col("_number").cast("string"))
        return placed.withColumn("_pack", F.when(F.col("_count") > 1, name)).drop("_count")

    def _log_schema(self, scans: list[DataFrame]) -> int:
        united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
        data_cols = [c for c in united.columns if not c.startswith("_")]
        log = self.catalog.schema_log(self.spark)
        current = schema_json(detect_schema(united.where("_reject is null"), data_cols), self.source.table_name)
        drift = materialize(schema_drift(current, log.read()), "drift")
        new_log = materialize(schema_log_rows(drift, self.ts), "schema_rows")
        if not new_log.isEmpty():
            log.append(new_log)
        return drift.select("schema_version").first()[0]

    def _fail(self, files: DataFrame, error) -> int:
        return self._record(files, "failed", error)

    def _record(self, files: DataFrame, status: str, error=None, counts: DataFrame | None = None) -> int:
        """Fold ledger rows in; only the buckets of these files are rewritten. Returns their number."""
        records = materialize(file_records(files, self.source.file_type, self.ts, status, error, counts), "ledger_rows")
        n = records.count()
        if n:
            self.ledger.upsert(records, LEDGER_KEY, merge=ledger_upsert)
        return n


def _has_header(header) -> Column:
    return F.col("header") == F.array(*[F.lit(h) for h in header]).cast("array<string>")
