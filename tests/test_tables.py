"""Versioned tables: commits, two writers, touched buckets, appends, expiry."""

import os

import pytest
from conftest import rows

from vaultline.operators import schema as S
from vaultline.sinks.tables import CommitConflict, VersionedTable, _FS


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v long")


def files(tmp):
    return {os.path.join(d, n) for d, _, ns in os.walk(f"{tmp}/t/data") for n in ns if n.endswith(".parquet")}


def test_the_second_of_two_writers_fails_and_the_first_keeps_its_rows(spark, tmp):
    a, b = VersionedTable(spark, f"{tmp}/t"), VersionedTable(spark, f"{tmp}/t")
    a.overwrite(frame(spark, [("x", 1)]), "k")
    base = b.version()
    a.upsert(frame(spark, [("y", 2)]), "k")
    for write in (lambda: b.upsert(frame(spark, [("z", 3)]), "k", base=base), lambda: b.append(frame(spark, [("z", 3)]), base=base),
                  lambda: b.overwrite(frame(spark, [("z", 3)]), "k", base=base)):
        with pytest.raises(CommitConflict):
            write()
    assert rows(a.read()) == [("x", 1), ("y", 2)] and a.version() == 2
    b.upsert(frame(spark, [("z", 3)]), "k")
    assert rows(a.read()) == [("x", 1), ("y", 2), ("z", 3)]


def test_a_commit_that_cannot_be_written_is_an_error(spark, tmp):
    assert _FS(spark, f"{tmp}/t").create_new("{}", "_commits", "1.json")
    assert not _FS(spark, f"{tmp}/t").create_new("{}", "_commits", "1.json")
    with open(f"{tmp}/file", "w"):
        pass
    with pytest.raises(Exception, match="(?i)directory|parent|exists"):
        _FS(spark, f"{tmp}/file").create_new("{}", "_commits", "1.json")
    assert sorted(os.listdir(f"{tmp}/t/_commits")) == [".1.json.crc", "1.json"] or os.listdir(f"{tmp}/t/_commits") == ["1.json"]


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, tmp):
    t = VersionedTable(spark, f"{tmp}/t", buckets=8)
    t.overwrite(frame(spark, [(f"k{i}", i) for i in range(400)]), "k")
    before = files(tmp)
    assert len(before) == 8
    t.upsert(frame(spark, [("k7", -7)]), "k")
    assert len(files(tmp) - before) == 1
    got = dict(rows(t.read()))
    assert len(got) == 400 and got["k7"] == -7 and got["k8"] == 8


def test_an_append_rewrites_nothing(spark, tmp):
    t = VersionedTable(spark, f"{tmp}/t")
    t.append(frame(spark, [("a", 1)]).coalesce(1))
    before = files(tmp)
    t.append(frame(spark, [("a", 1)]).coalesce(1))
    assert before < files(tmp) and len(files(tmp)) == 2 and rows(t.read()) == [("a", 1), ("a", 1)]


def test_empty_tables_and_old_versions(spark, tmp):
    t = VersionedTable(spark, f"{tmp}/t")
    assert t.read() is None and t.expire() == []
    t.overwrite(frame(spark, []), "k")
    assert t.read().collect() == [] and t.read().columns == ["k", "v"]
    for i in range(4):
        t.upsert(frame(spark, [("a", i), (f"b{i}", i)]), "k")
    assert rows(t.read(2)) == [("a", 0), ("b0", 0)]
    assert t.expire(keep=2)
    assert rows(t.read()) == [("a", 3), ("b0", 0), ("b1", 1), ("b2", 2), ("b3", 3)] and len(t.read(4).collect()) == 4
    assert sorted(n for n in os.listdir(f"{tmp}/t/_commits") if n.endswith("json")) == ["4.json", "5.json"]


def test_a_table_not_laid_out_by_the_key_is_merged_whole(spark, tmp):
    t = VersionedTable(spark, f"{tmp}/t")
    t.append(frame(spark, [("a", 1), ("b", 2)]))
    t.upsert(frame(spark, [("b", 3)]), "k")
    assert rows(t.read()) == [("a", 1), ("b", 3)]


def test_numbers_are_what_the_csv_reader_takes_for_numbers(spark):
    values = {"a": ["1d", "2"], "b": ["1.5", "2"], "c": ["1e3", ".5"], "d": ["1f", "1"], "e": ["inf", "2."], "f": ["1", "2"]}
    df = spark.createDataFrame([tuple(v[i] for v in values.values()) for i in range(2)], list(values))
    got = {r["name"]: r["type"] for r in S.detect_schema(df).collect()}
    assert got == {"a": "object", "b": "float64", "c": "float64", "d": "object", "e": "float64", "f": "int64"}


def test_the_number_of_buckets_follows_the_bytes(spark, tmp, monkeypatch):
    from vaultline.session import materialize
    from vaultline.sinks import tables
    t = VersionedTable(spark, f"{tmp}/t")
    wide = lambda a, b: materialize(frame(spark, [(f"k{i}", i) for i in range(a, b)]))
    t.overwrite(wide(0, 400), "k")
    assert t.commit_info()["buckets"] == 1
    monkeypatch.setattr(tables, "BUCKET_BYTES", 4000)
    t.upsert(wide(400, 3000), "k")  # outgrown: cut anew, nothing lost
    info = t.commit_info()
    assert info["buckets"] >= 4 and {p[0] for p in info["parts"]} == set(range(info["buckets"]))
    before = {p[1] for p in info["parts"]}
    t.upsert(frame(spark, [("k7", -7)]), "k")
    assert len({p[1] for p in t.commit_info()["parts"]} - before) == 1
    got = dict(rows(t.read()))
    assert len(got) == 3000 and got["k7"] == -7 and got["k2999"] == 2999


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp, monkeypatch):
    from vaultline.session import materialize
    from vaultline.sinks import tables
    monkeypatch.setattr(tables, "BUCKET_BYTES", 2000)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        t = VersionedTable(spark, f"{tmp}/t", buckets=2)
        t.overwrite(materialize(frame(spark, [(f"k{i}", i) for i in range(4000)])), "k")
    finally:
        spark.conf.set(key, "true")
    assert len(t.commit_info()["parts"]) == 2 and len(files(tmp)) > 2
    assert t.read().count() == 4000


def test_one_bucket_is_written_by_tasks_of_bounded_bytes(spark, tmp, monkeypatch):
    from vaultline.session import materialize
    from vaultline.sinks import tables
    monkeypatch.setattr(tables, "TASK_BYTES", 4000)
    t = VersionedTable(spark, f"{tmp}/t")
    t.overwrite(materialize(frame(spark, [(f"k{i}", i) for i in range(4000)])), "k")
    assert t.commit_info()["buckets"] == 1 and len(files(tmp)) > 2
    before = files(tmp)
    t.upsert(frame(spark, [("k7", -7), (None, 1)]), "k")
    assert len(files(tmp) - before) > 2
    got = dict(rows(t.read().na.fill("none")))
    assert len(got) == 4001 and got["k7"] == -7 and got["k8"] == 8 and got["none"] == 1


def test_small_change_sets_stand_beside_the_table_until_they_are_a_share_of_it(spark, tmp):
    from vaultline.sinks.tables import Newest
    t, rule = VersionedTable(spark, f"{tmp}/t"), Newest(("at",), "made")
    change = lambda made, *r: spark.createDataFrame([(k, at, made) for k, at in r], "k string, at long, made string").coalesce(1)
    t.upsert(change("first", *[(f"k{i}", i) for i in range(5000)]), "k", writer=("s", 0), merge=rule)
    base = files(tmp)
    for b in range(1, 5):  # k7 is renewed, k8 is offered an older row, a new key comes and is renewed
        t.upsert(change(f"b{b}", ("k7", 100 + b), ("k8", -b), ("new", b)), "k", writer=("s", b), merge=rule)
    assert base < files(tmp) and len(files(tmp)) == len(base) + 4  # nothing is rewritten
    want = {"k7": (104, "first"), "k8": (8, "first"), "new": (4, "b1")}
    seen = lambda: {r.k: (r.at, r.made) for r in t.read().collect()}
    assert len(seen()) == 5001 and want.items() <= seen().items() and t.read().columns == ["k", "at", "made"]
    assert t.upsert(change("again", ("k7", 999)), "k", writer=("s", 4), merge=rule) is None  # a replay
    assert t.stored().matching(change("x", ("new", 1)), "k").where("k = 'new'").count() == 1
    t.upsert(change("big", *[(f"k{i}", i + 1) for i in range(4000)]), "k", writer=("s", 5), merge=rule)  # merged with those before it
    assert {len(p) for p in t.commit_info()["parts"]} == {3} and len(seen()) == 5001
    assert {"k7": (104, "first"), "k8": (9, "first"), "new": (4, "b1")}.items() <= seen().items()
    t.upsert(change("late", ("new", 3)), "k", writer=("s", 6), merge=rule)
    t.upsert(change("plain", ("k8", 0)), "k")  # a merge by key takes in what stands beside the table
    assert {"k8": (0, "plain"), "new": (4, "b1")}.items() <= seen().items()
    t.expire(keep=1)
    assert len(seen()) == 5001 and {p[1].split("/")[1] for p in t.commit_info()["parts"]} == {f.split("/t/data/")[1].split("/")[0] for f in files(tmp)}


def test_a_target_is_read_where_the_change_set_falls(spark, tmp):
    from vaultline.operators.incremental import new_or_newer, preserve_created
    from vaultline.session import materialize
    from vaultline.sinks.ledgers import process_stats
    t = VersionedTable(spark, f"{tmp}/t", buckets=8)
    old = spark.createDataFrame([(f"k{i}", "2024-01-01", "2024-01-02") for i in range(400)], "k string, created_date string, at string")
    t.overwrite(old, "k")
    changes = materialize(spark.createDataFrame([("k7", "2025-01-01")], "k string, at string"))
    target = t.stored()
    whole = len(target.rows.inputFiles())
    assert whole == 8
    for df in (preserve_created(changes, target, "k", "2025-06-01 00:00:00"), new_or_newer(changes, target, "k", "at"),
               process_stats(target, changes, "k")):
        read = [f for f in df.inputFiles() if "/t/data/" in f]
        assert len(read) == 1, read
    assert [str(r.created_date) for r in preserve_created(changes, target, "k").collect()] == ["2024-01-01 00:00:00"]
    assert new_or_newer(changes, target, "k", "at").count() == 1
    assert tuple(process_stats(target, changes, "k").first()) == (1, 0, 1)


def test_folders_of_attempts_that_died_go_after_a_day(spark, tmp):
    t = VersionedTable(spark, f"{tmp}/t")
    t.overwrite(frame(spark, [("a", 1)]), "k")
    for name, age in (("dead", 2 * 24 * 3600), ("running", 60)):
        os.makedirs(f"{tmp}/t/data/{name}")
        os.utime(f"{tmp}/t/data/{name}", (os.stat(f"{tmp}/t").st_mtime - age,) * 2)
    assert t.expire() == ["data/dead"]
    assert "running" in os.listdir(f"{tmp}/t/data") and rows(t.read()) == [("a", 1)]


def test_a_writer_finds_the_newest_version_without_listing_all(spark, tmp, monkeypatch):
    t, other = VersionedTable(spark, f"{tmp}/t"), VersionedTable(spark, f"{tmp}/t")
    t.append(frame(spark, [("a", 0)]))
    listings, commits = [], VersionedTable._commits
    monkeypatch.setattr(VersionedTable, "_commits", lambda self: listings.append(1) or commits(self))
    for i in range(1, 4):
        t.append(frame(spark, [("a", i)]))
    assert t.version() == 4 and not listings and len(t.read().collect()) == 4
    assert other.version() == 4 and t.commit_info(2)["version"] == 2 and t.commit_info()["version"] == 4
    for i in range(4, 7):
        other.append(frame(spark, [("a", i)]))
    assert t.version() == 7
    for i in range(7, 10):
        other.append(frame(spark, [("a", i)]))
    other.expire(keep=1)  # the versions that ``t`` knows are gone, and so is the next one
    assert t.version() == 10 and t.append(frame(spark, [("a", 10)])) == 11 and len(t.read().collect()) == 11


def test_a_newest_merge_equals_brute_force_and_computes_what_orders_ties_for_ties_only(spark):
    import random
    from vaultline.sinks.tables import Newest
    rnd, some = random.Random(1), lambda *v: rnd.choice([None, *v])
    data = [(f"k{rnd.randrange(60)}", some(1, 2, 3), some(1, 2), some("x", "y"), w) for w in [None, *range(1, 9)] for _ in range(30)]
    data = list({(r[0], r[4]): r for r in data}.values())  # one row a key in every change set
    rows_of = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "k string, at long, n long, made string, _written long, id long")
    got = {r.k: (r.id, r.made) for r in Newest(("at", "n"), "made").of(rows_of, ["k"]).collect()}
    low = float("-inf")
    age = lambda r: -1 if r[4] is None else r[4]
    want = {}
    for k in {r[0] for r in data}:
        mine = [(i, r) for i, r in enumerate(data) if r[0] == k]
        best = min(mine, key=lambda x: (*(-(low if v is None else v) for v in x[1][1:3]), age(x[1])))
        want[k] = best[0], next((r[3] for _, r in sorted(mine, key=lambda x: age(x[1])) if r[3] is not None), None)
    assert got == want and len(got) > 40
    single = spark.createDataFrame([("a", 1, "m", None), ("a", 2, "m", 1), ("b", 1, "m", None)], "k string, at long, made string, _written long")
    parsed = Newest(("at", "raise_error('parsed')"), "made")
    assert rows(parsed.of(single, ["k"]), "k", "at") == [("a", 2), ("b", 1)]


def test_change_sets_that_older_code_put_beside_a_table_keep_their_place(spark, tmp):
    import json
    from vaultline.sinks.tables import Newest
    t, rule = VersionedTable(spark, f"{tmp}/t"), Newest(("at",), "made")
    change = lambda made, *r: spark.createDataFrame([(k, at, made) for k, at in r], "k string, at long, made string").coalesce(1)
    t.upsert(change("first", *[(f"k{i}", i) for i in range(5000)]), "k", writer=("s", 0), merge=rule)
    t.upsert(change("b1", ("new", 1)), "k", writer=("s", 1), merge=rule)
    part = t.commit_info()["parts"][-1][1]
    old = change("b1", ("new", 1)).selectExpr("*", "2L as _written")
    old.write.mode("overwrite").parquet(f"{tmp}/t/{part}")  # as it was stored before: a number
    t.upsert(change("b2", ("new", 1)), "k", writer=("s", 2), merge=rule)
    assert json.loads(open(f"{tmp}/t/_commits/3.json").read())["parts"][-1][3] == "beside"
    assert [tuple(r) for r in t.read().where("k = 'new'").collect()] == [("new", 1, "b1")] and t.read().count() == 5001
