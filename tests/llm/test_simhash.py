import random

import numpy as np
import pyarrow.parquet as pq
import xxhash

from conftest import SF_SMALL
from llm_fixtures import make_docs

from vaultline.llm import simhash
from vaultline.llm.components import connected_components


def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, fps, radius=4):
    parent = {i: i for i in range(len(ids))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                if a != b:
                    parent[a] = b
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(ids))]


def collect(df):
    return {r["id"]: (r["fp"] % (1 << 64), r["component"]) for r in df.collect()}


def test_documents_against_brute_force(spark):
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    fps = [plain_fingerprint(x) for x in t["text"]]
    want = dict(zip(t["doc_id"], zip(fps, plain_components(t["doc_id"], fps))))
    assert collect(simhash.near_duplicates(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))) == want


def test_xxh64_is_sparks_hash(spark):
    for s in ("", "a", "some words of a text, longer than thirty-two bytes", "éß"):
        got = spark.sql("select xxhash64(:s) h", args={"s": s}).first().h % (1 << 64)
        assert got == xxhash.xxh64_intdigest(s.encode(), 42)


def test_bit_planes_equal_popcount():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = np.concatenate([base ^ np.uint64(1 << k) ^ np.uint64(1 << 3 * k) for k in range(12)] + [base])
    for radius in (0, 1, 3, 4, 7):
        got = simhash.links_within(near, radius)
        dist = np.bitwise_count(near[:, None] ^ near[None, :])
        assert (got == (np.triu(dist <= radius, 1))).all()


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = make_docs(spark, [None, "", " \t\n", "one", "ONE", "a b c", long, long + " tail"]).withColumn("id", docs_id())
    got = collect(simhash.near_duplicates(docs))
    assert got[0] == got[1] == got[2] == (0, 0)
    assert got[3] == got[4] and got[3][1] == 3
    assert got[6][1] == got[7][1] == 6
    assert simhash.near_duplicates(make_docs(spark, []).limit(0)).collect() == []


def docs_id():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_large_buckets_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=300)
    texts = []
    for _ in range(60):
        w = list(base)
        w[rng.randrange(300)] = "x"
        texts.append(" ".join(w))
    texts += [" ".join(rng.choices(words, k=50)) for _ in range(40)]
    fps = [plain_fingerprint(t) for t in texts]
    want = dict(enumerate(zip(fps, plain_components(range(len(texts)), fps))))
    assert collect(simhash.near_duplicates(make_docs(spark, texts))) == want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(50))


def bits(monkeypatch):
    """Texts are fingerprints, written as hex digits."""
    from pyspark.sql import functions as F
    signed = lambda c: F.conv(c, 16, -10).cast("long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, id_col, text_col, shingle, key=None: docs.select(
        (F.lit(None) if key is None else key).cast("long").alias("key"), F.col(id_col).cast("long").alias("id"), signed(F.col(text_col)).alias("fp")))


def test_a_null_id_bridges_but_never_names(spark, monkeypatch):
    bits(monkeypatch)
    docs = make_docs(spark, [(1, "0"), (None, "f"), (2, "ff"), (None, "ffff0000ffff0000"), (9, "ffff0000")])
    got = sorted(((r.id, r.component) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (None, 1), (2, 1), (None, None), (9, 9)], key=str)


def test_longer_keys_find_the_same_links(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = collect(simhash.near_duplicates(docs, agree=2))
    assert collect(simhash.near_duplicates(docs, agree=4)) == want
    assert simhash._agreeing(250_000, 4) == 2 < simhash._agreeing(50_000_000_000, 4)


def test_one_of_each_loses_no_text(spark):
    from pyspark.sql import functions as F
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = make_docs(spark, [(1, a), (1, b), (2, b), (None, c), (None, c), (3, c), (4, a), (4, a), (5, None), (6, "")])
    for name in ("id", "fp", "key", "root", "_copy", "_again", "_id", "_text", "k"):
        docs = docs.withColumn(name, F.lit(7))
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, a), (1, b), (3, c), (5, None)], key=str)
    nameless = make_docs(spark, [(None, a), (None, a), (None, b)])
    assert sorted(r.text for r in simhash.one_of_each(nameless).collect()) == [a, b]
    assert simhash.one_of_each(docs.limit(0)).collect() == []
