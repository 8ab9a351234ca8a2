"""Table storage on plain Parquet.

* Raw tables are append-only and partitioned by ingestion date and file, or pack of small
  files: their rows become visible as one directory, so writing them again replaces it
  and what is there is there whole. A manifest names the files of a pack before its rows
  are written.
* ``VersionedTable`` keeps merged tables and logs. Every attempt writes into a folder
  of its own; a small commit file names the folders that make up a version and is put
  in place by a rename that fails if the version exists. Readers take the highest
  version. A merge rewrites only the key buckets that its change set touches.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vaultline.operators.incremental import Stored, upsert


class CommitConflict(RuntimeError):
    """Another writer committed the version this one was based on."""


class _FS:
    """Hadoop file access through the session (works for any cluster file system)."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, *parts: str):
        p = self.root
        for part in parts:
            p = self.jvm.org.apache.hadoop.fs.Path(p, part)
        return p

    def list_names(self, *parts: str) -> list[str]:
        p = self.path(*parts)
        if not self.fs.exists(p):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(p)]

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.path(*parts))

    def create_new(self, text: str, *parts: str) -> bool:
        """Put a whole small file in place; False if it exists already, other errors are raised."""
        target = self.path(*parts)
        draft = self.jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        hadoop = self.jvm.org.apache.hadoop.fs
        no_overwrite = self.gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(target.getParent().toUri(), self.conf).rename(
                self.fs.makeQualified(draft), self.fs.makeQualified(target), no_overwrite)
        except Exception as exc:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(exc):
                return False
            raise
        return True

    def read_text(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def size(self, *parts: str) -> int:
        """Bytes of the files below."""
        return self.fs.getContentSummary(self.path(*parts)).getLength()

    def ages(self, *parts: str) -> list[tuple[str, float]]:
        """(name, seconds since it was changed) of what a folder holds."""
        p = self.path(*parts)
        return [(s.getPath().getName(), time.time() - s.getModificationTime() / 1000) for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


INGEST_DATE, FILE_PART = "_ingest_date", "_file_part"


def _by_part(df: DataFrame):
    day = F.to_date(F.col("_ingested_at").cast("timestamp_ntz"))
    # the letter keeps an all-digit hash from being read back as a number
    own = F.concat(F.lit("f"), "_file_hash")
    part = F.coalesce("_pack", own) if "_pack" in df.columns else own
    return (df.withColumn(INGEST_DATE, day).withColumn(FILE_PART, part).drop("_pack")
            .write.partitionBy(INGEST_DATE, FILE_PART).mode("overwrite"))


def append_raw(df: DataFrame, path: str) -> None:
    """Add files' rows to a raw table; a part written again on the same day replaces itself.

    A part is a file, or where ``_pack`` is given (not null) the pack it names, which must
    hold all files that the manifest gives it. Incremental readers turn their watermark
    into a partition predicate (``since_watermark``), so a run lists and reads only the
    days after the watermark. Columns are matched by name; new columns are allowed (read
    with schema merging after a logged drift).
    """
    _by_part(df).option("partitionOverwriteMode", "dynamic").parquet(path)


def reload_raw(df: DataFrame, path: str) -> None:
    """Drop and recreate a raw table from ``df``, in the layout of ``append_raw``."""
    _by_part(df).option("partitionOverwriteMode", "static").parquet(path)


def raw_exists(spark: SparkSession, path: str) -> bool:
    return any(n.startswith(f"{INGEST_DATE}=") for n in _FS(spark, path).list_names())


def stored_files(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame:
    """Distinct ``file_hash`` of the files whose rows a raw table holds.

    Only partition values are read: a part is a file, or a pack of the files that
    ``manifest`` (pack, file_hash) lists for it. A pack that was announced but never
    written is not there, and its files are not stored.
    """
    if not raw_exists(spark, path):
        return spark.createDataFrame([], "file_hash string")
    parts = spark.read.parquet(path).select(F.col(FILE_PART).alias("pack")).distinct()
    single = parts.where("pack like 'f%'").select(F.substring("pack", 2, 64).alias("file_hash"))
    if manifest is None:
        return single
    return single.unionByName(manifest.join(parts, "pack", "left_semi").select("file_hash")).distinct()


def read_raw(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Read a raw table. Merging file schemas reads every footer, so callers that know
    the table never drifted (one logged schema version) pass ``merge_schema=False``."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


# Bytes of a key bucket, and the most buckets a table is cut into (its commit file lists them all).
BUCKET_BYTES, MAX_BUCKETS = 256 << 20, 1 << 16
# Stored bytes that a task writes: a task sorts its rows by bucket, and they take many times these bytes in memory.
TASK_BYTES = 16 << 20
# Spark's default for a source of unknown size is about this or more.
UNKNOWN_BYTES = 1 << 62
# Unnamed folders of attempts that died are dropped after this time.
ORPHAN_SECONDS = 24 * 3600


# Change sets stand beside a table until they are this share of its bytes, or this many; then they are merged into it.
BESIDE_SHARE, MAX_BESIDE = 0.5, 1000
# The version that put a change set beside the table; null in merged rows, which are older. It is stored as text: text is
# no part of the code that is compiled for a query, a number would make every batch compile its code anew.
_WRITTEN, _WRITTEN_TEXT = "_written", "_written_text"


@dataclass(frozen=True)
class Newest:
    """A merge that a table can also make when it is read: of a key's rows the first under ``order`` (SQL, descending)
    stays, of equal ones the one written first, with ``first`` taken from the row that was written first."""

    order: Sequence[str]
    first: str

    def of(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        of_key, written = Window.partitionBy(*keys), F.coalesce(_WRITTEN, F.lit(-1))
        leading, *others = self.order
        by_leading = of_key.orderBy(F.expr(leading).desc())
        first = F.min_by(self.first, F.when(F.col(self.first).isNotNull(), written))
        # one sort gives the leading rows; the other order expressions, which may parse text, are computed for ties only
        led = rows.select("*", first.over(by_leading.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_first"),
                          F.rank().over(by_leading).alias("_rank"),
                          F.count(F.lit(1)).over(by_leading.rangeBetween(Window.currentRow, Window.currentRow)).alias("_ties")).where("_rank = 1")
        place = F.row_number().over(of_key.orderBy(*[F.when(F.col("_ties") > 1, F.expr(o)).desc() for o in others], written))
        return (led.withColumn("_place", place).where("_place = 1")
                .withColumn(self.first, F.col("_first")).drop("_first", "_rank", "_ties", "_place", _WRITTEN))


def _input_bytes(df: DataFrame) -> int:
    """Bytes of what a frame reads: exact for stored tables, 0 for sources whose size Spark does not know."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < UNKNOWN_BYTES)


class VersionedTable:
    """Versions of a table; a version is a list of folders, each a key bucket or an appended part.

    A table is cut into as many buckets as its bytes need (``BUCKET_BYTES`` each), and
    into more when it has outgrown them, unless ``buckets`` fixes their number. The
    commit needs a store whose rename without overwrite is atomic (HDFS and its kin, a
    local disk); S3-like stores are not such a store.

    With a ``Newest`` merge, small change sets are put beside the table as they come and
    merged when they add up to a share of it, so a row is rewritten a fixed number of times
    however many change sets follow. Readers see them merged.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self._fs = _FS(spark, self.path)
        self._newest: tuple[int, dict] | None = None  # the last commit met: commits are never changed

    def _commits(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._fs.list_names("_commits") if n.endswith(".json"))

    def version(self) -> int | None:
        """The newest version: found one by one from the last commit met, so a stream's batches do not list all of them."""
        v = self._newest[0] if self._newest else None
        if v is not None:
            while self._fs.exists("_commits", f"{v + 1}.json"):
                v += 1
            if self._fs.exists("_commits", f"{v}.json"):  # else ``v + 1`` may be missing because both have expired
                return v
        c = self._commits()
        return c[-1] if c else None

    def commit_info(self, version: int | None = None) -> dict:
        v = self.version() if version is None else version
        if v is None:
            return {}
        if not self._newest or self._newest[0] != v:
            info = json.loads(self._fs.read_text("_commits", f"{v}.json"))
            if self._newest and v < self._newest[0]:
                return info
            self._newest = v, info
        return self._newest[1]

    def exists(self) -> bool:
        return self.version() is not None

    def _load(self, info: dict, parts: Sequence) -> DataFrame:
        schema = StructType.fromJson(info["schema"])
        if not parts:
            return self.spark.createDataFrame([], schema)
        if all(len(p) == 3 for p in parts):
            return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p[1]}" for p in parts])
        return self._newest_of(Newest(**info["newest"]), info, parts, info["key"])

    def _unmerged(self, info: dict, parts: Sequence) -> DataFrame:
        """All rows of the parts, those of change sets beside the table with the version that wrote them."""
        schema = StructType([*StructType.fromJson(info["schema"]).fields, StructField(_WRITTEN, LongType()), StructField(_WRITTEN_TEXT, StringType())])
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{p[1]}" for p in parts])
        return rows.withColumn(_WRITTEN, F.coalesce(_WRITTEN, F.col(_WRITTEN_TEXT).cast("bigint"))).drop(_WRITTEN_TEXT)  # older ones have numbers

    def _newest_of(self, rule: Newest, info: dict, parts: Sequence, keys: Sequence[str]) -> DataFrame:
        """The parts' rows merged; a task sorts about ``TASK_BYTES`` of them."""
        rows, tasks = self._unmerged(info, parts), -(-sum(p[2] for p in parts) // TASK_BYTES)
        if tasks > int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            rows = rows.repartition(tasks, *keys)
        return rule.of(rows, keys).select(*StructType.fromJson(info["schema"]).names)

    def read(self, version: int | None = None) -> DataFrame | None:
        info = self.commit_info(version)
        return self._load(info, info["parts"]) if info else None

    def stored(self, version: int | None = None) -> Stored | None:
        """This version as models take it: all rows, or the buckets that a change set's keys fall into."""
        info = self.commit_info(version)
        if not info:
            return None
        return Stored(self._load(info, info["parts"]), lambda changes, key: self._load(info, self._touched(info, changes, key)[0]))

    def _bucket_count(self, nbytes: int) -> int:
        return self.buckets or min(MAX_BUCKETS, 1 << (max(1, -(-nbytes // BUCKET_BYTES)) - 1).bit_length())

    @staticmethod
    def _bucket(keys: Sequence[str], buckets: int):
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _touched(self, info: dict, changes: DataFrame, key: str | Sequence[str]) -> tuple[list, list]:
        """Parts that may hold a key of ``changes``, and the rest."""
        keys, parts = [key] if isinstance(key, str) else list(key), info["parts"]
        if info.get("key") != keys or any(p[0] is None for p in parts):
            return parts, []  # not laid out by this key
        buckets = info["buckets"]
        if buckets == 1:
            return parts, []
        hit = {r[0] for r in changes.select(self._bucket(keys, buckets)).distinct().collect()}  # at most ``buckets``
        return [p for p in parts if p[0] in hit], [p for p in parts if p[0] not in hit]

    def _write_parts(self, df: DataFrame, keys: Sequence[str] | None, buckets: int, nbytes: int, filled: int = 0) -> tuple[str, list]:
        """Write into a new folder: the folder, and its parts as [bucket or None, folder, bytes].

        ``nbytes`` fall into ``filled`` buckets (default: all). A task writes about
        ``TASK_BYTES`` of them, so several tasks write a large bucket.
        """
        folder = f"data/{uuid.uuid4().hex}"
        if not keys:
            df.write.parquet(f"{self.path}/{folder}")
            return folder, [[None, folder, self._fs.size(folder)]]
        filled = filled or buckets
        salts = max(1, -(-nbytes // (filled * min(TASK_BYTES, BUCKET_BYTES))))
        salt, tasks = F.pmod(F.xxhash64(F.lit("salt"), *keys), F.lit(salts)), filled * salts
        (df.withColumn("_bucket", self._bucket(keys, buckets))
           .repartitionById(tasks, F.pmod(F.col("_bucket") * salts + salt, F.lit(tasks)).cast("int"))
           .write.partitionBy("_bucket").parquet(f"{self.path}/{folder}"))
        names = [n for n in self._fs.list_names(folder) if n.startswith("_bucket=")]
        return folder, [[int(n.split("=")[1]), f"{folder}/{n}", self._fs.size(folder, n)] for n in names]

    def _commit(self, base: int | None, schema: StructType, parts: list, before: dict, written: str,
                writer: tuple[str, int] | None = None, **info) -> int:
        """Put version ``base + 1`` in place; fails, and drops what was ``written`` for it, if another writer has done so."""
        v = (base or 0) + 1
        writers = before.get("writers", {}) | ({writer[0]: writer[1]} if writer else {})
        info = {"mark": before.get("mark")} | info
        body = json.dumps({"version": v, "schema": schema.jsonValue(), "parts": parts, "writers": writers, **info})
        if not self._fs.create_new(body, "_commits", f"{v}.json"):
            self._fs.delete(written)
            raise CommitConflict(f"version {v} of {self.path} was committed by another writer")
        self._newest = v, json.loads(body)
        return v

    def overwrite(self, df: DataFrame, key: str | Sequence[str] | None = None, base: int | None = -1, **info) -> int:
        """Replace the content. ``base`` is the version this is based on (default: the latest now)."""
        base = self.version() if base == -1 else base
        return self._replace(df, key, base, self.commit_info(base) if base else {}, _input_bytes(df), **info)

    def _replace(self, df: DataFrame, key, base: int | None, before: dict, nbytes: int, **info) -> int:
        keys = [key] if isinstance(key, str) else list(key or [])
        buckets = self._bucket_count(nbytes)
        folder, parts = self._write_parts(df, keys, buckets, nbytes)
        return self._commit(base, df.schema, parts, before, folder, mode="overwrite", key=keys, buckets=buckets, **info)

    def append(self, df: DataFrame, base: int | None = -1, writer: tuple[str, int] | None = None, **info) -> int | None:
        """Add rows: one more folder, nothing rewritten. A replay by ``writer`` is skipped as in ``upsert``."""
        base = self.version() if base == -1 else base
        before = self.commit_info(base) if base else {}
        if writer and self._replayed(before, writer):
            return None
        schema = StructType.fromJson(before["schema"]) if before else df.schema
        folder, parts = self._write_parts(df.select(*schema.names), None, 1, 0)
        kept = {k: before[k] for k in ("key", "buckets", "newest") if k in before}
        return self._commit(base, schema, before.get("parts", []) + parts, before, folder, writer, mode="append", **kept, **info)

    @staticmethod
    def _replayed(info: dict, writer: tuple[str, int]) -> bool:
        return writer[1] <= info.get("writers", {}).get(writer[0], -1)

    def has_batch(self, writer: tuple[str, int]) -> bool:
        """Whether the current version holds this batch of this stream."""
        return self._replayed(self.commit_info(), writer)

    def upsert(self, updates: DataFrame, key: str | Sequence[str], writer: tuple[str, int] | None = None, base: int | None = -1,
               merge: Callable[[DataFrame, DataFrame], DataFrame] | Newest | None = None, **info) -> int | None:
        """Merge ``updates`` (unique on ``key``, stored) into the current state.

        Only the buckets that hold a key of ``updates`` are read and rewritten. ``merge``
        gives their new rows from (stored rows, updates); the default replaces by key. With
        a ``Newest`` merge a small change set is put beside the table first.

        ``writer`` is (stream, batch) of an exactly-once writer: the last batch of every
        stream is committed with the version, and a batch that its own stream has
        committed before (a replay) is skipped and None returned. Other streams, and a
        stream that starts again under a new checkpoint, have numbers of their own.
        """
        base = self.version() if base == -1 else base
        keys = [key] if isinstance(key, str) else list(key)
        before = self.commit_info(base) if base else {}
        if writer and self._replayed(before, writer):
            return None
        if isinstance(merge, Newest):
            return self._upsert_newest(updates, keys, merge, base, before, writer, **info)
        added = _input_bytes(updates)
        if not before:
            rows = merge(updates.limit(0), updates) if merge else updates
            return self._replace(rows, keys, base, before, added, writer=writer, **info)
        schema = StructType.fromJson(before["schema"])
        touched, kept, buckets = self._layout(before, updates, keys, added)
        stored = self._load(before, touched)
        merged = merge(stored, updates) if merge else upsert(stored, updates, keys)
        folder, parts = self._write_parts(merged.select(*schema.names), keys, buckets, added + sum(p[2] for p in touched), self._filled(touched, kept))
        return self._commit(base, schema, kept + parts, before, folder, writer, mode="upsert", key=keys, buckets=buckets, **info)

    @staticmethod
    def _filled(touched: list, kept: list) -> int:
        """Buckets that a merge writes; 0 for all."""
        return len({p[0] for p in touched}) if kept else 0

    def _layout(self, before: dict, updates: DataFrame, keys: Sequence[str], added: int) -> tuple[list, list, int]:
        """Parts that a merge of ``updates`` rewrites, those it keeps, and the number of buckets it writes for."""
        buckets, needed = before.get("buckets") or 1, self._bucket_count(added + sum(p[2] for p in before["parts"]))
        touched, kept = self._touched(before, updates, keys)
        if not kept or needed > 2 * buckets:  # outgrown: cut anew
            return before["parts"], [], max(buckets, needed)
        return touched, kept, buckets

    def _upsert_newest(self, updates: DataFrame, keys: list, rule: Newest, base: int | None, before: dict, writer, **info) -> int:
        """Put a change set, computed here, beside the table; merge all that stand there where they are a share of it."""
        schema = StructType.fromJson(before["schema"]) if before else updates.schema
        written = F.lit(str((base or 0) + 1))
        folder, [part] = self._write_parts(updates.select(*schema.names).withColumn(_WRITTEN_TEXT, written), None, 1, 0)
        parts = before.get("parts", [])
        beside = [p for p in parts if len(p) > 3]
        later, total = part[2] + sum(p[2] for p in beside), part[2] + sum(p[2] for p in parts)
        if before.get("key") == keys and len(beside) < MAX_BESIDE and later < BESIDE_SHARE * (total - later):
            return self._commit(base, schema, parts + [[*part, "beside"]], before, folder, writer, mode="upsert", key=keys,
                                buckets=before["buckets"], newest=asdict(rule), **info)
        try:
            new = self._unmerged({"schema": schema.jsonValue()}, [part])
            if not before:
                return self._replace(new.drop(_WRITTEN), keys, base, before, part[2], writer=writer, **info)
            touched, kept, buckets = self._layout(before, new, keys, part[2])
            merged = self._newest_of(rule, before, [*touched, part], keys)
            target, merged_parts = self._write_parts(merged, keys, buckets, part[2] + sum(p[2] for p in touched), self._filled(touched, kept))
            return self._commit(base, schema, kept + merged_parts, before, target, writer, mode="upsert", key=keys, buckets=buckets, **info)
        finally:
            self._fs.delete(folder)

    def expire(self, keep: int = 2) -> list[str]:
        """Drop all but the newest ``keep`` versions, the folders only they use, and old folders of attempts that died."""
        versions = self._commits()
        old, new = versions[:-keep], versions[-keep:]
        used = {p[1] for v in new for p in self.commit_info(v)["parts"]}
        gone = sorted({p[1] for v in old for p in self.commit_info(v)["parts"]} - used)
        for v in old:
            self._fs.delete("_commits", f"{v}.json")
        for p in gone:
            self._fs.delete(p)
        named = {p.split("/")[1] for p in used}
        dead = [n for n, age in self._fs.ages("data") if n not in named and age > ORPHAN_SECONDS]
        for n in dead:
            self._fs.delete("data", n)
        return gone + [f"data/{n}" for n in dead]
