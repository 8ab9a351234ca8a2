"""CSV scan, NA tokens, per-file row numbers across splits, fingerprints, skip of seen files."""

import hashlib
import os

from conftest import rows
from pyspark.sql import functions as F

from vaultline.sinks.ledgers import file_records, ledger_upsert
from vaultline.sources import landing as L


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_scan_by_header_name_aliases_and_na(spark, tmp):
    _write(f"{tmp}/a/x.csv", "balance,accountid,customerid,account_type\n\"1,000.00\", ACC1 ,NA,Savings\n,ACC2,n/a,x\n")
    df = L.scan_csv(spark, f"{tmp}/a", L.ACCOUNT_COLUMNS, L.ACCOUNT_ALIASES)
    assert rows(df, *L.ACCOUNT_COLUMNS) == [(" ACC1 ", None, "1,000.00", "Savings"), ("ACC2", None, None, "x")]


def test_missing_column_is_an_error(spark, tmp):
    import pytest
    _write(f"{tmp}/a/x.csv", "AccountID,Balance\n1,2\n")
    with pytest.raises(ValueError):
        L.scan_csv(spark, f"{tmp}/a", L.ACCOUNT_COLUMNS)


def test_row_numbers_across_many_splits(spark, tmp):
    n1, n2 = 3000, 1234
    _write(f"{tmp}/l/one.csv", "AccountID,CustomerID,Balance,AccountType\n" +
           "".join(f"A{i},C{i},{i}.00,savings\n" + ("\n" if i % 97 == 0 else "") for i in range(1, n1 + 1)))
    _write(f"{tmp}/l/two.csv", "AccountID,CustomerID,Balance,AccountType\n" +
           "".join(f"B{i},C{i},{i}.00,savings\n" for i in range(1, n2 + 1)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scanned = L.scan_csv(spark, f"{tmp}/l", L.ACCOUNT_COLUMNS)
        assert scanned.rdd.getNumPartitions() > 10
        out = L.with_lineage(scanned, L.fingerprint(spark, f"{tmp}/l"), "2025-01-01 00:00:00").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {(r["AccountID"], r["_row_number"]) for r in out}
    want = {(f"A{i}", i) for i in range(1, n1 + 1)} | {(f"B{i}", i) for i in range(1, n2 + 1)}
    assert got == want
    with open(f"{tmp}/l/one.csv", "rb") as f:
        md5 = hashlib.md5(f.read()).hexdigest()
    assert {r["_file_hash"] for r in out if r["AccountID"].startswith("A")} == {md5}


def test_fingerprint_is_the_md5_of_the_bytes_at_every_size(spark, tmp, monkeypatch):
    monkeypatch.setattr(L, "READ_BYTES", 64)  # many pieces to a file
    texts = {"a.csv": "h\n1\n", "b.csv": "h,é\n" + "x,y\n" * 5000, "d.csv": '"a\nb",c\n"1\n2",3\n', "e.csv": "\ufeffh\r\n1\r\n"}
    for n, t in texts.items():
        _write(f"{tmp}/f/{n}", t)
    got = {r["path"].split("/")[-1]: r for r in L.fingerprint(spark, f"{tmp}/f").collect()}
    for n, t in texts.items():
        assert got[n]["file_hash"] == hashlib.md5(t.encode()).hexdigest()
    assert [got[n]["header"] for n in texts] == [["h"], ["h", "é"], ["a\nb", "c"], ["h"]]
    assert [got[n]["quoted_newline"] for n in texts] == [False, False, True, False]
    whole = {r["path"].split("/")[-1]: r for r in _through_spark(spark, f"{tmp}/f", monkeypatch)}
    assert whole == got  # a store that only Spark can open gives the same


def _through_spark(spark, path, monkeypatch):
    monkeypatch.setattr(L, "STREAMED", ())
    return L.fingerprint(spark, path).collect()


def test_every_file_is_read_by_its_own_header(spark, tmp):
    _write(f"{tmp}/h/a.csv", "AccountID,CustomerID,Balance,AccountType\nA1,C1,10,savings\n")
    _write(f"{tmp}/h/b.csv", "CustomerID,AccountID,Branch,AccountType,Balance\nC2,A2,north,savings,20\n")
    df = L.scan_csv(spark, f"{tmp}/h", L.ACCOUNT_COLUMNS, keep_extra=True)
    assert rows(df, *L.ACCOUNT_COLUMNS, "Branch") == [("A1", "C1", "10", "savings", None), ("A2", "C2", "20", "savings", "north")]
    import pytest
    _write(f"{tmp}/r/c.csv", "CustomerID,CustomerID,Name,HasLoan\n1,2,x,no\n")
    with pytest.raises(ValueError):
        L.scan_csv(spark, f"{tmp}/r", L.CUSTOMER_COLUMNS)


def test_quoted_fields(spark, tmp):
    _write(f"{tmp}/q/a.csv", 'CustomerID,Name,HasLoan\n1,"Ann ""The Pen"" Fox",no\n2,"x, ""y"", z",no\n3,"ends\\",no\n4,a\\b,yes\n')
    df = L.scan_csv(spark, f"{tmp}/q", L.CUSTOMER_COLUMNS)
    assert rows(df, *L.CUSTOMER_COLUMNS) == [("1", 'Ann "The Pen" Fox', "no"), ("2", 'x, "y", z', "no"), ("3", "ends\\", "no"),
                                             ("4", "a\\b", "yes")]


def test_empty_landing_folder_scans_to_no_rows(spark, tmp):
    os.makedirs(f"{tmp}/none")
    assert L.scan_csv(spark, f"{tmp}/none", L.CUSTOMER_COLUMNS).collect() == []


def test_unprocessed_skips_completed_hashes_only(spark, tmp):
    _write(f"{tmp}/u/a.csv", "h\n1\n")
    _write(f"{tmp}/u/b.csv", "h\n2\n")
    _write(f"{tmp}/u/c.csv", "h\n3\n")
    fp = L.fingerprint(spark, f"{tmp}/u")
    ts = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    done = file_records(fp.filter(F.col("path").endswith("a.csv")), "accounts", ts, "completed")
    failed = file_records(fp.filter(F.col("path").endswith("b.csv")), "accounts", ts, "failed", "boom")
    ledger = ledger_upsert(done, failed)
    pending = L.unprocessed(fp, ledger, "accounts")
    assert sorted(r["path"].split("/")[-1] for r in pending.collect()) == ["b.csv", "c.csv"]
    # retry succeeds: status and row count replace the failed record, identity stays
    ok = file_records(fp.filter(F.col("path").endswith("b.csv")), "accounts", ts, "completed",
                      row_counts=fp.select("path", F.lit(1).cast("bigint").alias("row_count")))
    led2 = ledger_upsert(ledger, ok)
    b = led2.filter(F.col("file_name") == "b.csv").first()
    assert (b["processing_status"], b["row_count"], b["error_message"]) == ("completed", 1, None)
    assert led2.count() == 2


def test_latest_file(spark, tmp):
    _write(f"{tmp}/n/accounts_1.csv", "h\n1\n")
    _write(f"{tmp}/n/accounts_2.csv", "h\n2\n")
    os.utime(f"{tmp}/n/accounts_1.csv", (2_000_000_000, 2_000_000_000))
    got = L.latest_file(L.list_landing(spark, f"{tmp}/n", prefix="accounts")).first()
    assert got["file_name"] == "accounts_1.csv"


def test_pair_gate(spark):
    from vaultline.plans.gates import pair_gate
    led = spark.createDataFrame(
        [("accounts", "completed", "2025-01-02 00:00:00"), ("customers", "failed", "2025-01-02 00:00:00"),
         ("customers", "completed", "2025-01-01 00:00:00")],
        "file_type string, processing_status string, ingestion_timestamp string") \
        .withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))
    assert pair_gate(led).first()["ready"] is True
    r = pair_gate(led, since="2025-01-01 12:00:00").first()
    assert (r["accounts_ready"], r["customers_ready"], r["ready"]) == (True, False, False)


def test_export_layout_is_what_was_asked_for(spark, tmp):
    from vaultline.sinks.export import export_csv
    df = spark.range(0, 1000).selectExpr("cast(id % 37 as string) as k", "id as v", "'say \"x\", y' as t").repartition(7)
    assert export_csv(df, f"{tmp}/one", ["k", "v"]) == 1000
    assert len([f for f in os.listdir(f"{tmp}/one") if f.endswith(".csv")]) == 1
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # keep the range partitions of this tiny input apart
    try:
        assert export_csv(df, f"{tmp}/many", ["k", "v"], single_file=False) == 1000
    finally:
        spark.conf.set(key, "true")
    parts = sorted(f for f in os.listdir(f"{tmp}/many") if f.endswith(".csv"))
    assert len(parts) > 1
    import csv
    for name in ("one", "many"):
        got = []
        for p in sorted(f for f in os.listdir(f"{tmp}/{name}") if f.endswith(".csv")):
            with open(f"{tmp}/{name}/{p}", newline="") as fh:
                got += list(csv.reader(fh))[1:]
        assert len(got) == 1000 and got == sorted(got, key=lambda t: (t[0], int(t[1]))) and got[0][2] == 'say "x", y'
    assert export_csv(df.limit(0), f"{tmp}/none", ["k"]) == 0 and not os.path.exists(f"{tmp}/none")


def test_unseen_skips_completed_files_without_hashing(spark, tmp):
    _write(f"{tmp}/s/a.csv", "h\n1\n")
    _write(f"{tmp}/s/b.csv", "h\n2\n")
    listing = L.list_landing(spark, f"{tmp}/s")
    ts = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    from vaultline.session import materialize
    led = materialize(file_records(L.fingerprint(spark, f"{tmp}/s"), "accounts", ts, "completed"))  # stored ledger
    assert L.unseen(listing, led, "accounts").count() == 0
    os.utime(f"{tmp}/s/b.csv", (2_000_000_000, 2_000_000_000))  # rewritten in place
    again = L.unseen(L.list_landing(spark, f"{tmp}/s"), led, "accounts")
    assert [r["file_name"] for r in again.collect()] == ["b.csv"]
    # same bytes as an ingested file: hashed, then skipped by content
    assert L.unprocessed(L.fingerprint(spark, [r["path"] for r in again.collect()]), led, "accounts").count() == 0


def test_quoted_line_breaks_are_found_and_count_as_one_record(spark, tmp):
    _write(f"{tmp}/m/c.csv", 'CustomerID,Name,HasLoan\n1,"alice\nsmith",yes\n2,bob,no\n')
    _write(f"{tmp}/m/d.csv", "CustomerID,Name,HasLoan\n3,eve,no\n")
    scanned = L.scan_csv(spark, f"{tmp}/m", L.CUSTOMER_COLUMNS)
    out = L.with_lineage(scanned, L.fingerprint(spark, f"{tmp}/m"), "2025-01-01 00:00:00")
    assert rows(out, "CustomerID", "Name", "_row_number") == [("1", "alice\nsmith", 1), ("2", "bob", 2), ("3", "eve", 1)]


HEAD = "AccountID,CustomerID,Balance,AccountType\n"


def _catalog(tmp):
    from vaultline.plans.ingest import Catalog
    return Catalog(f"{tmp}/wh")


def test_retry_after_a_late_failure_adds_no_row_twice(spark, tmp, monkeypatch):
    import pytest

    from vaultline.plans import ingest as I
    _write(f"{tmp}/in/a.csv", HEAD + "A1,C1,1,savings\nA2,C1,2,savings\n")
    cat, message = _catalog(tmp), "the log is gone " * 200
    append = I.VersionedTable.append

    def fail(self, *args, **kw):
        raise OSError(message)

    monkeypatch.setattr(I.VersionedTable, "append", fail)  # the rows are written, the schema log is not
    with pytest.raises(OSError):
        I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    row = cat.ledger(spark).read().first()
    assert (row["processing_status"], row["error_message"]) == ("failed", message)
    monkeypatch.setattr(I.VersionedTable, "append", append)
    assert I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-02 00:00:00", "all_unseen")["status"] == "completed"
    raw = spark.read.parquet(cat.raw("raw_accounts"))
    assert rows(raw, "AccountID") == [("A1",), ("A2",)]
    row = cat.ledger(spark).read().first()
    assert (row["processing_status"], row["row_count"], row["error_message"]) == ("completed", 2, None)


def test_the_same_bytes_under_new_names_add_nothing(spark, tmp, monkeypatch):
    from vaultline.plans import ingest as I
    monkeypatch.setattr(L, "READ_BYTES", 1000)
    body = HEAD + "".join(f"A{i},C1,{i},savings\n" for i in range(2000))
    _write(f"{tmp}/in/a.csv", body)
    _write(f"{tmp}/in/twin.csv", body)
    cat = _catalog(tmp)
    assert I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")["files"] == 1
    _write(f"{tmp}/in/again.csv", body)
    assert I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-02 00:00:00", "all_unseen")["status"] == "skipped"
    assert spark.read.parquet(cat.raw("raw_accounts")).count() == 2000


def test_reload_replaces_a_raw_table_in_the_same_layout(spark, tmp):
    from vaultline.plans import ingest as I
    from vaultline.sinks.tables import read_raw, reload_raw, stored_files
    _write(f"{tmp}/in/a.csv", HEAD + "A1,C1,1,savings\n")
    cat = _catalog(tmp)
    I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00")
    raw = cat.raw("raw_accounts")
    fresh = read_raw(spark, raw).drop("_ingest_date", "_file_part").withColumn("_file_hash", F.lit("0" * 32))
    fresh = spark.createDataFrame(fresh.collect(), fresh.schema)
    reload_raw(fresh, raw)
    assert [r.file_hash for r in stored_files(spark, raw).collect()] == ["0" * 32]
    assert rows(read_raw(spark, raw), "AccountID", "_file_hash") == [("A1", "0" * 32)]


def _status(spark, cat):
    return {r.file_name: (r.processing_status, r.row_count, (r.error_message or "").split(":")[0])
            for r in cat.ledger(spark).read().collect()}


def test_bad_files_are_failed_one_by_one_and_good_ones_complete(spark, tmp):
    from vaultline.plans import ingest as I
    _write(f"{tmp}/in/a.csv", HEAD + "A1,C1,1,savings\n")
    _write(f"{tmp}/in/b.csv", HEAD.replace(",AccountType", "") + "A2,C1,1\n")
    _write(f"{tmp}/in/empty.csv", "\n\n")
    _write(f"{tmp}/in/nothing.csv", "")  # not listed: an upload that has not begun
    _write(f"{tmp}/in/other.csv", "AccountType,Branch," + HEAD.replace(",AccountType", "") + "savings,x,A3,C1,3\n")
    with open(f"{tmp}/in/latin.csv", "wb") as f:
        f.write(HEAD.replace("Balance", "Bal\u00e4nce").encode("latin-1") + b"A4,C1,1,savings\n")
    cat = _catalog(tmp)
    got = I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    assert (got["status"], got["files"], got["failed"], got["rejected"]) == ("partial", 2, 3, 0)
    status = _status(spark, cat)
    assert {n: s[:2] for n, s in status.items()} == {"a.csv": ("completed", 1), "other.csv": ("completed", 1), "b.csv": ("failed", 0),
                                                     "empty.csv": ("failed", 0), "latin.csv": ("failed", 0)}
    assert status["b.csv"][2].startswith("landing file lacks columns ['AccountType']")
    assert status["empty.csv"][2] == "landing file has no header" and status["latin.csv"][2] == "UnicodeDecodeError"
    assert rows(spark.read.parquet(cat.raw("raw_accounts")), "AccountID") == [("A1",), ("A3",)]
    _write(f"{tmp}/in/b.csv", HEAD + "A2,C1,1,savings\n")  # delivered anew
    got = I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-02 00:00:00", "all_unseen")
    assert (got["status"], got["files"], got["failed"]) == ("partial", 1, 2)
    assert rows(spark.read.parquet(cat.raw("raw_accounts")), "AccountID") == [("A1",), ("A2",), ("A3",)]


def test_only_bad_files_fail_without_stopping_a_run(spark, tmp):
    from vaultline.plans import ingest as I
    _write(f"{tmp}/in/a.csv", "x,y\n1,2\n")
    got = I.ingest(spark, _catalog(tmp), I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    assert (got["status"], got["files"], got["failed"]) == ("failed", 0, 1)


def test_records_that_are_too_long_are_rejected_with_their_text(spark, tmp):
    from vaultline.plans import ingest as I
    body = 'A1,C1,"1,000",savings\nA2,C1,1,000,savings\nA3,C1\nA4,C1,4,savings,\n"A,5","C""1",5,"x,y"\nA6,C1,6,"open, text",z\n'
    _write(f"{tmp}/in/a.csv", HEAD + body)
    _write(f"{tmp}/in/b.csv", HEAD + "B1,C1,1,savings\n")
    cat = _catalog(tmp)
    got = I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    assert (got["status"], got["files"], got["rejected"]) == ("completed", 2, 3)
    raw = spark.read.parquet(cat.raw("raw_accounts")).select("AccountID", "CustomerID", "Balance", "AccountType", "_row_number")
    assert sorted(map(tuple, raw.collect()), key=str) == [("A,5", 'C"1', "5", "x,y", 5), ("A1", "C1", "1,000", "savings", 1),
                                                         ("A3", "C1", None, None, 3), ("B1", "C1", "1", "savings", 1)]
    bad = spark.read.parquet(cat.rejects("raw_accounts"))
    assert rows(bad, "_row_number", "record") == [(2, "A2,C1,1,000,savings"), (4, "A4,C1,4,savings,"), (6, 'A6,C1,6,"open, text",z')]
    assert _status(spark, cat)["a.csv"][:2] == ("completed", 3)


def test_a_file_that_fails_while_it_is_loaded_is_taken_out(spark, tmp, monkeypatch):
    from vaultline.plans import ingest as I
    for k in range(4):
        _write(f"{tmp}/in/f{k}.csv", HEAD + f"A{k},C1,{k},savings\n")
    blocks, cat = L.block_table, _catalog(tmp)

    def gone(scanned):
        if os.path.exists(f"{tmp}/in/f2.csv"):
            os.remove(f"{tmp}/in/f2.csv")
        return blocks(scanned)

    monkeypatch.setattr(L, "block_table", gone)
    got = I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    assert (got["status"], got["files"], got["failed"]) == ("partial", 3, 1)
    assert {n: s[0] for n, s in _status(spark, cat).items()} == {f"f{k}.csv": "failed" if k == 2 else "completed" for k in range(4)}
    assert rows(spark.read.parquet(cat.raw("raw_accounts")), "AccountID") == [("A0",), ("A1",), ("A3",)]


def test_small_files_share_a_raw_part_and_a_lost_pack_is_written_again(spark, tmp, monkeypatch):
    import pytest

    from vaultline.plans import ingest as I
    from vaultline.sinks.tables import stored_files
    for k in range(300):
        _write(f"{tmp}/in/f{k:03d}.csv", HEAD + f"A{k},C1,{k},savings\n")
    cat, append = _catalog(tmp), I.append_raw

    def lost(df, path):
        raise OSError("the store is gone")

    monkeypatch.setattr(I, "append_raw", lost)  # the pack is announced, its rows are not written
    with pytest.raises(OSError):
        I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    assert {s[0] for s in _status(spark, cat).values()} == {"failed"}
    monkeypatch.setattr(I, "append_raw", append)
    monkeypatch.setattr(I, "PACK_BYTES", 5000)
    for day in (2, 3):
        I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", f"2025-01-0{day} 00:00:00", "all_unseen")
    raw = spark.read.parquet(cat.raw("raw_accounts"))
    assert raw.count() == 300 == raw.select("AccountID").distinct().count()
    assert 2 <= raw.select("_file_part").distinct().count() < 10
    assert len([n for n in os.listdir(f"{tmp}/wh/raw/raw_accounts") if n.startswith("_ingest_date")]) == 1
    assert stored_files(spark, cat.raw("raw_accounts"), cat.manifest(spark, "raw_accounts").read()).count() == 300
    # a ledger that is lost: nothing is written again
    cat.ledger(spark)._fs.delete()
    I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-04 00:00:00", "all_unseen")
    assert spark.read.parquet(cat.raw("raw_accounts")).count() == 300


def test_a_pack_is_written_by_tasks_of_bounded_bytes(spark, tmp, monkeypatch):
    from vaultline.plans import ingest as I
    monkeypatch.setattr(I, "TASK_BYTES", 1000)
    for k in range(60):
        _write(f"{tmp}/in/f{k:03d}.csv", HEAD + "".join(f"A{k}_{i},C1,{k},savings\n" for i in range(5)))
    cat = _catalog(tmp)
    I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    raw = spark.read.parquet(cat.raw("raw_accounts"))
    assert raw.count() == 300 == raw.select("AccountID").distinct().count() and raw.select("_file_part").distinct().count() == 1
    assert len(raw.inputFiles()) > 2


def test_files_are_ingested_in_slices(spark, tmp, monkeypatch):
    from vaultline.plans import ingest as I
    monkeypatch.setattr(I, "SLICE_FILES", 2)
    for k in range(5):
        _write(f"{tmp}/in/f{k}.csv", HEAD + f"A{k},C1,{k},savings\n")
    cat = _catalog(tmp)
    got = I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    assert (got["status"], got["files"], got["schema_version"]) == ("completed", 5, 1)
    assert spark.read.parquet(cat.raw("raw_accounts")).count() == 5


def test_a_file_with_quoted_line_breaks_is_read_in_splits(spark, tmp, monkeypatch):
    """Row numbers and values equal the one-split scan, wherever the splits are cut."""
    import random
    rng = random.Random(4)
    text = ['CustomerID,Name,HasLoan\n']
    for i in range(300):
        name = rng.choice(["plain", '"two\nlines"', '"a ""quoted"" word"', '"\n\n"', '"comma, and\r\nbreak"', '""', '"\n  \n"', '"""\n"""'])
        text.append(f"{i},{name},{rng.choice(['yes', 'no', ''])}" + rng.choice(["\n", "\n\n"]))
    _write(f"{tmp}/p/a.csv", "".join(text))
    _write(f"{tmp}/p/dos.csv", 'CustomerID,Name,HasLoan\r\n1,"x\r\ny",no\r\n\r\n2,"z",\r\n')
    _write(f"{tmp}/p/b.csv", 'CustomerID,Name,HasLoan\n1,"x\ny",no')  # no line end at the end
    _write(f"{tmp}/p/stray.csv", 'CustomerID,Name,HasLoan\n1,5" pipe,no\n2,"two\nlines",yes\n')  # a quote inside a plain field

    def scan():
        found = L.scan_csv(spark, f"{tmp}/p", L.CUSTOMER_COLUMNS, keep_rejects=True)
        out = L.with_lineage(found, L.fingerprint(spark, f"{tmp}/p"), "2025-01-01 00:00:00")
        return rows(out.select("_source_file", "_row_number", *[F.coalesce(c, F.lit("?")) for c in L.CUSTOMER_COLUMNS]))

    want = scan()
    assert len(want) == 305
    monkeypatch.setattr(L, "QUOTED_SPLIT_BYTES", 0)
    kinds = {r.path.rpartition("/")[2]: (r.quoted_newline, r.regular_quotes) for r in L.fingerprint(spark, f"{tmp}/p").collect()}
    assert kinds == {"a.csv": (True, True), "b.csv": (True, True), "dos.csv": (True, True), "stray.csv": (True, False)}
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (37, 64, 1000):
        spark.conf.set(key, size)
        try:
            assert scan() == want
        finally:
            spark.conf.set(key, before)


def test_a_quoted_field_that_is_not_closed_fails_its_file(spark, tmp):
    from vaultline.plans import ingest as I
    _write(f"{tmp}/in/a.csv", HEAD + 'A1,C1,"1,savings\nA2,C1,2,savings\n')
    _write(f"{tmp}/in/b.csv", HEAD + "B1,C1,1,savings\n")
    cat = _catalog(tmp)
    got = I.ingest(spark, cat, I.ACCOUNTS, f"{tmp}/in", "2025-01-01 00:00:00", "all_unseen")
    assert (got["status"], got["files"], got["failed"]) == ("partial", 1, 1) and _status(spark, cat)["a.csv"][2] == "ValueError"
