import random

import pyarrow.parquet as pq
import pytest

from conftest import SF_ORACLE
from llm_fixtures import make_docs
from pyspark.sql import functions as F

from vaultline.llm import decontam


def plain_tiles(doc, item, k):
    """Greedy string tiling as stated: longest free match, leftmost in the item, then in the document."""
    used_d, used_i, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while (a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n]
                       and not used_i[a + n] and not used_d[b + n]):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < k:
            return total
        used_i[a:a + n] = used_d[b:b + n] = [True] * n
        total += n


def found(docs, bench, **kw):
    return {(r.id, r.item_id): r.n_matched for r in decontam.find_leaks(docs, bench, **kw).collect()}


def bench_of(spark, items):
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")


@pytest.mark.parametrize("bound", [1 << 30, 0])
def test_random_texts_against_plain_tiling(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "MAX_SENT_BYTES", bound)
    rng = random.Random(7)
    items = [" ".join(rng.choices("abcd", k=rng.randrange(3, 14))) for _ in range(12)]
    docs = [" ".join(rng.choices("abcd", k=rng.randrange(0, 40))) for _ in range(60)]
    want = {}
    for d, t in enumerate(docs):
        for i, x in enumerate(items):
            m = plain_tiles(t.split(), x.split(), 3)
            if len(x.split()) >= 3 and m >= 0.6 * len(x.split()):
                want[d, i] = m
    assert want and found(make_docs(spark, docs), bench_of(spark, items), min_match=3, min_coverage=0.6) == want


def test_planted_passages(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    item = [word() for _ in range(40)]
    noise = lambda n: [word() for _ in range(n)]
    swapped = item[20:] + noise(30) + item[:20]
    cut = item[:12] + noise(50)
    docs = [" ".join(noise(100) + item + noise(50)), ", ".join(noise(10) + [w.upper() for w in item]), " ".join(swapped),
            " ".join(cut), " ".join(noise(300))]
    assert set(found(make_docs(spark, docs), bench_of(spark, [" ".join(item)]))) == {(0, 0), (1, 0), (2, 0)}


def test_all_items_in_the_test_documents_are_found(spark):
    docs = pq.read_table(f"{SF_ORACLE}/documents.parquet").to_pydict()
    items = pq.read_table(f"{SF_ORACLE}/benchmark.parquet").to_pydict()
    norm = lambda t: " " + " ".join(x.decode() for x in decontam.tokens(t.encode())) + " "
    texts = {d: norm(t) for d, t in zip(docs["doc_id"], docs["text"])}
    want = {(d, i) for i, x in zip(items["item_id"], items["text"]) for d, t in texts.items() if norm(x) in t}
    got = found(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet"))
    assert want and set(got) == want


@pytest.mark.parametrize("bound", [1 << 30, 0])
def test_edge_cases(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "MAX_SENT_BYTES", bound)
    passage = "one two three four five six seven eight"
    docs = make_docs(spark, [None, "", passage, passage, "w " * 60_000 + passage, "tiny"]).withColumn("item_id", F.lit("clash")) \
        .withColumn("_leaks_row", F.lit(0)).withColumn("key", F.lit(1)).withColumn("t", F.lit("clash"))
    rows = [(0, passage), (0, passage), (1, "tiny"), (2, None), (None, passage), (3, "")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    assert set(found(docs, bench)) == {(2, 0), (3, 0), (4, 0)}
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 5]
    assert found(docs.limit(0), bench) == {} and found(docs, bench.limit(0)) == {}
    assert decontam.clean(docs, bench.limit(0)).count() == 6


@pytest.mark.parametrize("bound", [1 << 30, 0])
def test_rows_without_a_unique_id_are_judged_one_by_one(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "MAX_SENT_BYTES", bound)
    passage = "one two three four five six seven eight"
    docs = make_docs(spark, [(None, passage), (None, passage), (None, "clean"), (7, passage), (7, passage), (7, "other text"), (7, None)])
    bench = bench_of(spark, [passage])
    leaks = [(r.id, r.item_id, r.n_matched) for r in decontam.find_leaks(docs, bench).collect()]
    assert sorted(leaks, key=str) == sorted([(None, 0, 8)] * 2 + [(7, 0, 8)] * 2, key=str)
    kept = [(r.doc_id, r.text) for r in decontam.clean(docs, bench).collect()]
    assert sorted(kept, key=str) == sorted([(None, "clean"), (7, "other text"), (7, None)], key=str)
