"""Streamed upsert: order-insensitive, exactly once; streamed tables and ingestion equal the batch ones."""

import datetime as dt
import os
from decimal import Decimal

from conftest import rows

from vaultline.plans import ingest as I
from vaultline.plans import models as M
from vaultline.sinks.tables import VersionedTable
from vaultline.streaming.jobs import ACCOUNTS, ingest_stream, stream_structured, upsert_batch

RAW = ("AccountID string, CustomerID string, Balance string, AccountType string, _source_file string, "
       "_file_hash string, _row_number int, _ingested_at timestamp_ntz")
RUN = "2025-01-01 00:00:00"


def test_upsert_batch_keeps_newest_and_skips_replays(spark, tmp):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    newer = spark.createDataFrame([("A1", "C1", "200", "savings", "f2", "h2", 1, t2)], RAW)
    older = spark.createDataFrame([("A1", "C1", "100", "savings", "f1", "h1", 1, t1), ("A2", "C1", "5", "savings", "f1", "h1", 2, t1)], RAW)
    table = VersionedTable(spark, f"{tmp}/t")
    assert upsert_batch(table, ACCOUNTS, newer, ("s", 0), RUN) == 1
    assert upsert_batch(table, ACCOUNTS, older, ("s", 1), "2025-01-02 00:00:00") == 2   # arrives late
    assert upsert_batch(table, ACCOUNTS, older, ("s", 1), RUN) is None  # replay skipped
    assert rows(table.read(), "account_id", "original_balance") == [("A1", Decimal("200.00")), ("A2", Decimal("5.00"))]
    assert {str(r[0]) for r in rows(table.read().where("account_id = 'A1'"), "created_date")} == {RUN}
    assert table.commit_info()["writers"] == {"s": 1}


def test_streamed_accounts_equal_the_batch_table(spark, tmp):
    data = [(f"A{i % 7}", "C1", f"{i}.00", "savings", "f", "h", i, dt.datetime(2024, 1, 1 + i % 5)) for i in range(1, 60)]
    raw = spark.createDataFrame(data, RAW)
    raw.repartition(6).write.parquet(f"{tmp}/raw")
    stream_structured(spark, ACCOUNTS, f"{tmp}/raw", f"{tmp}/str", f"{tmp}/ck", raw.schema, max_files_per_trigger=2,
                      run_ts_of_batch=lambda b: RUN).awaitTermination()
    want = M.str_accounts(raw, None, RUN)
    got = VersionedTable(spark, f"{tmp}/str").read()
    assert got.columns == want.columns and rows(got) == rows(want)


def test_stream_ingestion_follows_the_batch_rules(spark, tmp):
    cat, head, pairs = I.Catalog(f"{tmp}/wh"), "AccountID,CustomerID,Balance,AccountType\n", []
    os.makedirs(f"{tmp}/in")

    def land(name, text):
        with open(f"{tmp}/in/{name}", "w") as f:
            f.write(text)

    def drain(checkpoint):
        ingest_stream(spark, cat, I.ACCOUNTS, f"{tmp}/in", f"{tmp}/{checkpoint}", run_ts_of_batch=lambda b: RUN,
                      on_pair=pairs.append).awaitTermination()

    land("a.csv", head + "A1,C1,1,savings\n")
    drain("ck")
    land("b.csv", "customerid,AccountID,AccountType,Balance,Branch\nC2,A2,savings,\"2,000\",north\n")  # reordered, drifted
    land("a_again.csv", head + "A1,C1,1,savings\n")
    drain("ck")
    drain("lost")  # a new checkpoint offers every file again
    raw = spark.read.option("mergeSchema", True).parquet(cat.raw("raw_accounts"))
    assert rows(raw, "AccountID", "CustomerID", "Balance", "Branch", "_row_number") == [
        ("A1", "C1", "1", None, 1), ("A2", "C2", "2,000", "north", 1)]
    assert sorted(r.processing_status for r in cat.ledger(spark).read().collect()) == ["completed"] * 2
    assert cat.schema_log(spark).read().count() == 2 and pairs == []
    os.makedirs(f"{tmp}/cust")
    with open(f"{tmp}/cust/c.csv", "w") as f:
        f.write("CustomerID,Name,HasLoan\nC1,x,no\n")
    I.ingest(spark, cat, I.CUSTOMERS, f"{tmp}/cust", RUN)
    land("d.csv", head + "A3,C1,3,savings\n")
    drain("ck")
    assert len(pairs) == 1
    os.utime(f"{tmp}/in/a_again.csv", (2_000_000_000, 2_000_000_000))  # delivered again, known bytes: no new pair
    drain("ck")
    land("bad.csv", "no,header\n1,2\n")  # a bad file fails by itself, the stream goes on
    drain("ck")
    assert len(pairs) == 1 and {r.processing_status for r in cat.ledger(spark).read().where("file_name = 'bad.csv'").collect()} == {"failed"}
    land("e.csv", head + "A4,C1,4,savings\n")
    drain("ck")
    assert len(pairs) == 2 and pairs[0]["customers"] == pairs[1]["customers"] and pairs[0]["accounts"] < pairs[1]["accounts"]


def test_a_pair_fires_once_whoever_sees_it(spark, tmp, monkeypatch):
    from vaultline.streaming import jobs
    from vaultline.streaming.jobs import fire_pair
    cat, fired, at = I.Catalog(f"{tmp}/wh"), [], dt.datetime(2024, 1, 1)
    newest = lambda a, c: spark.createDataFrame([("accounts", a), ("customers", c)], "file_type string, modified timestamp_ntz")
    assert fire_pair(spark, cat, newest(at, None), ("one", 0), fired.append) is None
    pair, later = newest(at, at), newest(at, at + dt.timedelta(days=1))

    def dies(found):
        fired.append("died")
        raise OSError("the run died")

    try:
        fire_pair(spark, cat, pair, ("one", 0), dies)
    except OSError:
        pass
    assert fire_pair(spark, cat, pair, ("two", 0), fired.append) is None  # claimed by the first
    assert fire_pair(spark, cat, pair, ("one", 0), fired.append) and len(fired) == 2  # its replay calls again
    assert fire_pair(spark, cat, pair, ("one", 1), fired.append) is None and fire_pair(spark, cat, pair, ("two", 1), fired.append) is None
    assert fire_pair(spark, cat, later, ("two", 2), fired.append) and len(fired) == 3
    assert sorted(tuple(r) for r in cat.pair_log(spark).read().select("stream", "batch", "status").collect()) == [("one", 0, "done"), ("two", 2, "done")]
    last = newest(at, at + dt.timedelta(days=2))
    try:
        fire_pair(spark, cat, last, ("gone", 0), dies)
    except OSError:
        pass
    assert fire_pair(spark, cat, last, ("two", 3), fired.append) is None
    monkeypatch.setattr(jobs, "CLAIM_SECONDS", 0)  # the stream that claimed it never came back
    assert fire_pair(spark, cat, last, ("two", 3), fired.append) and len(fired) == 5


def test_a_lost_checkpoint_and_a_second_stream_lose_nothing(spark, tmp):
    day = lambda i: dt.datetime(2024, 1, 1 + i)
    row = lambda i, key, v: (key, "C1", v, "savings", "f", f"h{i}", i, day(i))

    def put(path, *data):
        spark.createDataFrame(list(data), RAW).coalesce(1).write.mode("append").parquet(path)

    def drain(path, checkpoint):
        stream_structured(spark, ACCOUNTS, path, f"{tmp}/t", f"{tmp}/{checkpoint}", spark.createDataFrame([], RAW).schema,
                          max_files_per_trigger=1, run_ts_of_batch=lambda b: RUN).awaitTermination()

    for i in range(3):
        put(f"{tmp}/one", row(i, f"A{i}", str(i)))
    drain(f"{tmp}/one", "ck1")  # batches 0-2
    put(f"{tmp}/two", row(4, "B", "4"), row(5, "A0", "50"))
    drain(f"{tmp}/two", "ck2")  # batch 0 of another stream
    put(f"{tmp}/new", row(6, "A9", "9"))
    drain(f"{tmp}/new", "ck3")  # batch 0 of a new checkpoint
    table = VersionedTable(spark, f"{tmp}/t")
    assert {k: str(v) for k, v in rows(table.read(), "account_id", "original_balance")} == {
        "A0": "50.00", "A1": "1.00", "A2": "2.00", "A9": "9.00", "B": "4.00"}
    assert sorted(table.commit_info()["writers"].values()) == [0, 0, 2]
    version = table.version()
    drain(f"{tmp}/one", "lost")  # every file again, from batch 0: merged again, nothing changes
    assert table.version() == version + 3
    assert [str(r[0]) for r in rows(table.read().where("account_id = 'A0'"), "original_balance")] == ["50.00"]
    drain(f"{tmp}/one", "lost")
    assert table.version() == version + 3


def test_a_streamed_merge_goes_on_top_of_another_writers_commit(spark, tmp, monkeypatch):
    new = lambda k, v: spark.createDataFrame([(k, "C1", v, "savings", "f", "h", 1, dt.datetime(2024, 1, 1))], RAW)
    table, other = VersionedTable(spark, f"{tmp}/t"), VersionedTable(spark, f"{tmp}/t")
    upsert_batch(table, ACCOUNTS, new("A", "1"), ("s", 0), RUN)
    write, raced = VersionedTable._write_parts, []

    def race(self, *args):
        if not raced:
            raced.append(1)
            upsert_batch(other, ACCOUNTS, new("B", "2"), ("t", 0), RUN)
        return write(self, *args)

    monkeypatch.setattr(VersionedTable, "_write_parts", race)
    assert upsert_batch(table, ACCOUNTS, new("C", "3"), ("s", 1), RUN) == 3
    assert [r[0] for r in rows(table.read(), "account_id")] == ["A", "B", "C"]
    assert table.commit_info()["writers"] == {"s": 1, "t": 0}
    used = {p[1].split("/")[1] for v in (1, 2, 3) for p in table.commit_info(v)["parts"]}
    assert set(os.listdir(f"{tmp}/t/data")) == used  # the attempt that lost is gone


def test_strict_streams_set_late_rows_apart_once(spark, tmp):
    row = lambda key, v, day: (key, "C1", v, "savings", "f", "h", 1, day and dt.datetime(2024, 1, day))
    batch = lambda *data: spark.createDataFrame(list(data), RAW)
    table, late = VersionedTable(spark, f"{tmp}/t"), VersionedTable(spark, f"{tmp}/late")
    assert upsert_batch(table, ACCOUNTS, batch(row("A", "1", 5), row("B", "1", 3)), ("s", 0), RUN, late) == 1
    assert not late.exists() and table.commit_info()["mark"].startswith("2024-01-05")
    second = batch(row("A", "2", 5), row("C", "2", 4), row("D", "2", None), row("B", "2", 6))
    assert upsert_batch(table, ACCOUNTS, second, ("s", 1), RUN, late) == 2
    assert upsert_batch(table, ACCOUNTS, second, ("s", 1), RUN, late) is None
    assert {k: str(v) for k, v in rows(table.read(), "account_id", "original_balance")} == {"A": "1.00", "B": "2.00"}
    assert sorted(r.AccountID for r in late.read().collect()) == ["A", "C", "D"]
    assert upsert_batch(table, ACCOUNTS, batch(row("A", "3", 6)), ("s", 2), RUN, late) == 3  # nothing new in it
    assert table.commit_info()["mark"].startswith("2024-01-06") and late.read().count() == 4


def test_a_small_batch_is_one_job_and_compiles_no_code_of_its_own(spark, tmp):
    codegen = getattr(spark.sparkContext._jvm, "org.apache.spark.metrics.source.CodegenMetrics$").__getattr__("MODULE$")
    compiled = lambda: codegen.METRIC_COMPILATION_TIME().getCount()
    row = lambda i: (f"A{i}", "C1", f"{i}.00", "savings", "f", "h", i, dt.datetime(2024, 1, 1 + i % 5))

    def drain(*batches):
        for b in batches:
            spark.createDataFrame([row(i) for i in b], RAW).coalesce(1).write.mode("append").parquet(f"{tmp}/raw")
        before = compiled()
        query = stream_structured(spark, ACCOUNTS, f"{tmp}/raw", f"{tmp}/t", f"{tmp}/ck", spark.createDataFrame([], RAW).schema,
                                  max_files_per_trigger=1, run_ts_of_batch=lambda b: RUN)
        query.awaitTermination()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(query.runId)), compiled() - before

    drain(range(5000))
    drain(range(5000, 5010))
    assert drain(range(5010, 5020), range(5, 15), range(5020, 5030)) == (3, 0)
    table = VersionedTable(spark, f"{tmp}/t")
    assert table.version() == 5 and len(table.commit_info()["parts"]) == 5  # all beside the first
    assert sorted(int(k[1:]) for k, in rows(table.read(), "account_id")) == list(range(5030))
