"""Landing-zone ingestion: listing, fingerprints, CSV scan, lineage columns.

Nothing here brings file contents to the driver: listings, hashes, header names and
row numbers are DataFrames computed by the executors.
"""

from __future__ import annotations

import csv
import hashlib
import io
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vaultline.functions.columns import na_to_null
from vaultline.operators.incremental import _ntz
from vaultline.session import materialize

ACCOUNT_COLUMNS = ("AccountID", "CustomerID", "Balance", "AccountType")
CUSTOMER_COLUMNS = ("CustomerID", "Name", "HasLoan")
# Header spellings of other deliveries, mapped onto the raw schema.
ACCOUNT_ALIASES = {"accountid": "AccountID", "customerid": "CustomerID", "balance": "Balance",
                   "account_type": "AccountType", "accounttype": "AccountType"}
CUSTOMER_ALIASES = {"customerid": "CustomerID", "name": "Name", "hasloan": "HasLoan"}

# Quoted fields as RFC 4180 writes them: a doubled quote stands for one, a backslash for itself.
CSV_QUOTING = {"quote": '"', "escape": '"'}
CSV_TEXT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", **CSV_QUOTING}
# Bytes of a file that a task holds at once.
READ_BYTES = 1 << 20
# Bytes from which a file with quoted line breaks is read in splits.
QUOTED_SPLIT_BYTES = 128 << 20
# Schemes that executors can open as a stream; other stores are read through Spark.
STREAMED = ("file", "hdfs", "s3", "gs")


def _chunks(path: str) -> Iterable[bytes]:
    """A file's bytes in fixed-size pieces."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    store, name = (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(path)
    with store.open_input_stream(name) as f:
        while piece := f.read(READ_BYTES):
            yield piece


# Bytes that may stand before an opening quote: a comma, a line end, the other half of a doubled quote.
_BEFORE_QUOTE = np.isin(np.arange(256), list(b',\n\r"'))


def examine(pieces: Iterable[bytes]) -> tuple[str, list[str], bool, bool]:
    """MD5 of the bytes, header names, whether a quoted field holds a line break, and whether
    every quote opens or closes a field or is doubled inside one."""
    md5, head, open_quote, broken, regular, last = hashlib.md5(), b"", False, False, True, 10
    header_done = False
    for piece in pieces:
        md5.update(piece)
        b = np.frombuffer(piece, np.uint8)
        inside = (np.cumsum(b == 34) + open_quote) & 1
        opens = np.flatnonzero((b == 34) & (inside == 1))
        regular = regular and bool(_BEFORE_QUOTE[np.where(opens > 0, b[opens - 1], last)].all())
        last = int(b[-1])
        line_end = b == 10
        broken = broken or bool((line_end & (inside == 1)).any())
        if not header_done:
            ends = np.flatnonzero(line_end & (inside == 0))
            header_done = len(ends) > 0
            head += piece[:ends[0]] if header_done else piece
        open_quote = bool(inside[-1])
    if open_quote and regular:
        raise ValueError("a quoted field is not closed")
    names = next(csv.reader(io.StringIO(head.decode("utf-8-sig").rstrip("\r"), newline="")), [])
    return md5.hexdigest(), names, broken, regular


def _files(spark: SparkSession, directory: str | Sequence[str], prefix: str, suffix: str, recursive: bool) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*{suffix}")
            .option("recursiveFileLookup", recursive).load(directory))


def list_landing(spark: SparkSession, directory: str | Sequence[str], prefix: str = "", suffix: str = ".csv",
                 recursive: bool = True) -> DataFrame:
    """(path, file_name, length, modificationTime) of landing files; content is not read, files of no bytes are left out."""
    return _files(spark, directory, prefix, suffix, recursive).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "modificationTime")


_EXAMINED = ("path string, length long, modificationTime timestamp, file_hash string, header array<string>, "
             "quoted_newline boolean, regular_quotes boolean, error string")


def _examined(pieces: Iterable[bytes]) -> tuple:
    """``examine``, or the error that this one file gives."""
    try:
        return *examine(pieces), None
    except Exception as exc:  # a file that is gone, unreadable or not text must not stop the others
        return None, [], False, True, f"{type(exc).__name__}: {exc}"


def fingerprint(spark: SparkSession, directory: str | Sequence[str], prefix: str = "", suffix: str = ".csv") -> DataFrame:
    """(path, length, modificationTime, file_hash, header, quoted_newline, regular_quotes, error) per file.

    ``error`` says why a file cannot be read (its hash is null then); it is null for all others.

    The hash is the MD5 of the bytes for files of every size. Executors read each file
    once, a fixed piece at a time; a store that only Spark can open is read as whole
    files (``binaryFile``), with the same result.
    """
    files = _files(spark, directory, prefix, suffix, True)
    first = files.select("path").first()
    streamed = first is None or first.path.partition(":")[0] in STREAMED

    def run(batches):
        for b in batches:
            pieces = [_chunks(p) for p in b.column("path").to_pylist()] if streamed else [[c] for c in b.column("content").to_pylist()]
            found = list(zip(*map(_examined, pieces))) or [()] * 5
            types = [pa.string(), pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("length"), b.column("modificationTime"),
                                              *[pa.array(f, t) for f, t in zip(found, types)]],
                                             [c.split()[0] for c in _EXAMINED.split(", ")])

    columns = ["path", "length", "modificationTime"] + ([] if streamed else ["content"])
    return files.select(*columns).mapInArrow(run, _EXAMINED)


def scan_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
             aliases: Mapping[str, str] | None = None, keep_extra: bool = False,
             files: DataFrame | None = None, keep_rejects: bool = False) -> DataFrame:
    """CSV with a header, every column as text, NA tokens → NULL, selected by name.

    Every file is read by its own header: files with the same header (and the same need
    for quoted line breaks) are one scan, and the scans are united by name, so a
    reordered or wider file mixes nothing up. Names match case-insensitively, with
    ``aliases``. ``files`` is a stored ``fingerprint`` of the files; without it they are
    examined first. Files split freely; of those with quoted line breaks, the ones
    beyond ``QUOTED_SPLIT_BYTES`` by the parity of their quotes (``_scan_parity``), small
    and irregularly quoted ones are one split. Adds ``_path`` and ``_block`` from the
    hidden ``_metadata`` column, and ``_pos``, a row's place in its file where the scan
    knows it (null otherwise).

    A record with fewer fields than the header ends in nulls. With ``keep_rejects``, a
    record with more fields is a row whose ``_reject`` holds its text (null in all others).
    """
    if files is None:
        files = materialize(fingerprint(spark, path), "landing_files")
    parity = F.col("quoted_newline") & F.col("regular_quotes") & (F.col("length") > QUOTED_SPLIT_BYTES)
    layouts = files.groupBy("header", "quoted_newline", parity.alias("parity")).agg(F.collect_list("path").alias("paths")).collect()
    scans = [_scan_layout(spark, r.header, r.paths, r.quoted_newline, columns, aliases, keep_extra, keep_rejects, r.parity) for r in layouts]
    own = ("_path", "_block", "_pos", *(["_reject"] if keep_rejects else []))
    if not scans:
        fields = [StructField(c, LongType() if c in ("_block", "_pos") else StringType()) for c in (*columns, *own)]
        return spark.createDataFrame([], StructType(fields))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    extra = [c for c in united.columns if c not in columns and c not in own]
    return united.select(*columns, *extra, *own)


def _places(header: Sequence[str], aliases: Mapping[str, str] | None) -> dict[str, int]:
    """Lower-case column name -> place in the header."""
    return {(aliases or {}).get(n.strip().lower(), n.strip()).lower(): i for i, n in enumerate(header)}


def header_error(header: Sequence[str], columns: Sequence[str], aliases: Mapping[str, str] | None = None) -> str | None:
    """Why files with this header cannot be loaded; None if they can."""
    places = _places(header, aliases)
    missing = [c for c in columns if c.lower() not in places]
    if not header:
        return "landing file has no header"
    if missing or len(places) < len(header):
        return f"landing file lacks columns {missing} or repeats one; header is {list(header)}"
    return None


def _too_long(record: str, fields: int):
    """Whether a record's text has more fields than the header: commas outside quoted parts."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(bare) - F.length(F.translate(bare, ",", "")) >= fields


def _scan_parity(spark: SparkSession, paths: Sequence[str], fields: StructType, options: Mapping[str, str]) -> DataFrame:
    """Rows of files whose quoted fields hold line breaks, read in splits: ``fields``, ``_path``, ``_block`` 0, ``_pos``.

    A line starts a record if the quotes before it are even in number. Each split counts
    its quotes and its record starts for both states it may begin in; a prefix sum over
    the splits (one row each) gives the true state and the records before it, so every
    line knows its record, also where that began in the split before. A record's lines
    are then joined in order and parsed as one.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_rid"))
    of_split = Window.partitionBy("_path", "_block").orderBy("_rid")
    lines = lines.withColumn("_quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    lines = lines.withColumn("_odd", F.coalesce(F.sum("_quotes").over(of_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)
    filled = F.trim(F.regexp_replace("value", r"[\t\r]", " ")) != ""
    lines = lines.select("*", *[F.count(F.when((F.col("_odd") == k) & filled, 1)).over(of_split).alias(f"_starts{k}") for k in (0, 1)])
    lines = materialize(lines.withColumn("_blank", ~filled), "quoted_lines")

    splits = lines.groupBy("_path", "_block").agg((F.sum("_quotes") % 2).alias("odd"), F.max("_starts0").alias("s0"), F.max("_starts1").alias("s1"),
                                                   F.min_by(F.col("value").endswith("\r"), "_rid").alias("cr"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_state", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    starts = F.when(F.col("_state") == 0, F.col("s0")).otherwise(F.col("s1"))
    splits = materialize(splits.withColumn("_before", F.coalesce(F.sum(starts).over(before), F.lit(0)))
                         .withColumn("_crlf", F.first("cr").over(Window.partitionBy("_path").orderBy("_block")))
                         .select("_path", "_block", "_state", "_before", "_crlf"), "quoted_splits")
    placed = lines.join(splits, ["_path", "_block"])
    placed = placed.withColumn("_rec", F.col("_before") + F.when(F.col("_state") == 0, F.col("_starts0")).otherwise(F.col("_starts1")))
    placed = placed.where(~(F.col("_blank") & (F.col("_odd") == F.col("_state"))))  # a blank line between records is none
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_rid", "value"))), lambda x: x["value"]), "\n")
    # line ends of the file's kind inside a field become plain ones, as in the one-split scan
    text = F.when(F.max("_crlf"), F.replace(F.regexp_replace(joined, "\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(joined)
    records = placed.where("_rec > 1").groupBy("_path", "_rec").agg(text.alias("record"))
    parsed = F.from_csv("record", fields.simpleString(), dict(options) | {"multiLine": "true", "mode": "PERMISSIVE"})
    return records.select(parsed.alias("r"), "_path", F.lit(0).cast("long").alias("_block"), (F.col("_rec") - 1).alias("_pos")).select("r.*", "_path", "_block", "_pos")


def _scan_layout(spark, header, paths, multiline, columns, aliases, keep_extra, keep_rejects=False, parity=False) -> DataFrame:
    """One scan of files that share a header."""
    if error := header_error(header, columns, aliases):
        raise ValueError(error)
    lookup = _places(header, aliases)
    by_place = StructType([StructField(f"c{i}", StringType()) for i in range(len(header))])
    options, rejects = dict(CSV_TEXT), []
    if keep_rejects:  # Spark gives the text of records whose number of fields is not the header's
        by_place.add("_malformed", StringType())
        options |= {"columnNameOfCorruptRecord": "_malformed", "columnPruning": "false"}
        # Spark refuses a scan of this column alone, so the first one is named as well
        parsed = F.col("c0").isNull() | F.col("c0").isNotNull()
        long = F.col("_malformed").isNotNull() & _too_long("_malformed", len(header)) & parsed
        rejects = [F.when(long, F.col("_malformed")).alias("_reject")]
    if parity:
        df = _scan_parity(spark, paths, by_place, options)
    else:
        reader = spark.read.options(**options).option("header", True).option("multiLine", multiline).option("mode", "PERMISSIVE")
        df = reader.schema(by_place).csv(paths).select("*", F.col("_metadata.file_path").alias("_path"),
                                                       F.col("_metadata.file_block_start").alias("_block"), F.lit(None).cast("long").alias("_pos"))
    wanted = [na_to_null(f"c{lookup[c.lower()]}").alias(c) for c in columns]
    known = {c.lower() for c in columns}
    extra = [na_to_null(f"c{i}").alias(header[i].strip()) for n, i in lookup.items() if n not in known] if keep_extra else []
    return df.select(*wanted, *extra, "_path", "_block", "_pos", *rejects)


def latest_file(listing: DataFrame) -> DataFrame:
    """The newest file (ties broken by path), as a one-row DataFrame."""
    newest = F.max(F.struct("modificationTime", "path", "file_name", "length"))
    return listing.agg(newest.alias("f")).select("f.path", "f.file_name", "f.length", "f.modificationTime") \
        .filter(F.col("path").isNotNull())


def unseen(listing: DataFrame, ledger: DataFrame | None, file_type: str | None = None) -> DataFrame:
    """Listed files that are not already ``completed`` under the same (path, size, mtime).

    Only these need their bytes hashed; a landing folder that keeps years of files
    is listed every run but hashed only for what is new or rewritten.
    """
    if ledger is None:
        return listing
    done = ledger.filter(F.col("processing_status") == "completed")
    if file_type is not None:
        done = done.filter(F.col("file_type") == file_type)
    seen = done.select(F.col("file_path").alias("path"), F.col("file_size_bytes").alias("length"),
                       F.col("modification_time").alias("modificationTime"))
    return listing.join(seen, ["path", "length", "modificationTime"], "left_anti")


def unprocessed(listing: DataFrame, ledger: DataFrame | None, file_type: str | None = None) -> DataFrame:
    """Files whose (file_type, hash) is not ``completed`` in the ledger — re-delivered bytes are skipped."""
    if ledger is None:
        return listing
    done = ledger.filter(F.col("processing_status") == "completed")
    if file_type is not None:
        done = done.filter(F.col("file_type") == file_type)
    return listing.join(done.select("file_hash").distinct(), "file_hash", "left_anti")


def block_table(scanned: DataFrame) -> DataFrame:
    """Per (file, split): row count ``_n``, rejects ``_bad``, first row id ``_first``, rows before it in the file ``_offset``.

    Materialised in the shared checkpoint folder: one scan computes it, its size is
    then known exactly, and lineage is cut (safe against executor loss).
    The table is small (one row per split), so it is written once and read back.
    """
    base = scanned.withColumn("_rid", F.monotonically_increasing_id())
    bad = F.count("_reject") if "_reject" in scanned.columns else F.lit(0).cast("bigint")
    blocks = base.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), bad.alias("_bad"), F.min("_rid").alias("_first"))
    w = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(blocks.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0))), "blocks")


def with_row_numbers(scanned: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """``_row_number`` = 1-based data-row position within its file, without shuffling the rows.

    Row ids from ``monotonically_increasing_id`` are consecutive inside a split, so
    a row's position is ``_offset + (_rid - _first) + 1``. Only the per-split table
    (one row per file split) moves: it is stored, so the planner knows its bytes and
    broadcasts it under the session's threshold.
    """
    blocks = block_table(scanned) if blocks is None else blocks
    small = blocks.select("_path", "_block", "_first", "_offset")
    base = scanned.withColumn("_rid", F.monotonically_increasing_id())
    out = base.join(small, ["_path", "_block"], "inner")
    known = F.col("_pos") if "_pos" in scanned.columns else F.lit(None)
    number = F.coalesce(known, F.col("_offset") + F.col("_rid") - F.col("_first") + 1)
    return out.withColumn("_row_number", number.cast("long")).drop("_rid", "_first", "_offset", "_pos")


def file_row_counts(blocks: DataFrame) -> DataFrame:
    """Loaded rows per file (rejected records are not among them)."""
    return blocks.groupBy(F.col("_path").alias("path")).agg(F.sum(F.col("_n") - F.col("_bad")).cast("bigint").alias("row_count"))


def with_lineage(scanned: DataFrame, fingerprints: DataFrame, run_ts=None,
                 source_name=None, blocks: DataFrame | None = None) -> DataFrame:
    """Add ``_source_file``, ``_file_hash``, ``_row_number``, ``_ingested_at`` and drop helper columns."""
    numbered = with_row_numbers(scanned, blocks)
    fp = fingerprints.select(F.col("path").alias("_path"), F.col("file_hash").alias("_file_hash"))
    out = numbered.join(fp, "_path", "left")
    src = source_name(F.col("_path")) if source_name is not None else F.col("_path")
    return out.withColumn("_source_file", src).withColumn("_ingested_at", _ntz(run_ts)).drop("_path", "_block")
