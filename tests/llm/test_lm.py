import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from llm_fixtures import make_docs
from pyspark.sql import functions as F

from vaultline.llm import lm
from vaultline.session import materialize


def plain_base(pairs, held):
    """{id: (n_tokens, n_known, N, base_score)} counted in plain Python."""
    toks = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in pairs}
    c = Counter(w for i, ws in toks.items() if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for i, ws in toks.items()}


def held7(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("share", [lm.SHARE, 50])
def test_documents_against_plain_counts(spark, monkeypatch, share):
    monkeypatch.setattr(lm, "SHARE", share)  # 50: most words go through the join
    monkeypatch.setattr(lm, "COUNTED", 3000)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = lm.score(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    rows = {r.id: r for r in got.collect()}
    want = plain_base([(r.doc_id, r.text) for r in docs.collect()], held7)
    assert set(rows) == set(want)
    for i, (n, known, total, base) in want.items():
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, held7(i))
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
    per = {r.held_out: r for r in lm.perplexity(got).collect()}
    assert per[True].perplexity < per[True].base_perplexity


def test_probabilities_sum_to_one(spark):
    texts = ["a b c a b", "the cat sat", "The dog sat!", None, ""] * 4
    docs = make_docs(spark, texts)
    src = docs.select(F.col("text").alias("t"))
    words = lm.count_words(src)
    m = lm.learn(src, words)
    assert np.allclose((10 ** m.move).sum(1), 1)
    n = {int(k) % (1 << 64): c for k, c in ((r.name, r.c) for r in words.collect())}
    names = np.array(sorted(n), np.uint64)
    cls = m.classes[m.look_up(names)[2]]
    for c in np.unique(cls):
        size = sum(n[int(k)] + 1 for k in names[cls == c])
        assert math.isclose(size + 1, 10 ** m.spread[c], rel_tol=1e-9)


def likelihood(bigrams, of, classes):
    e = np.eye(classes)[of]
    t = e.T @ bigrams @ e
    h = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return h(t) - h(t.sum(0)) - h(t.sum(1))


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(2)
    b = rng.poisson(3, (25, 25)).astype(float)
    b[:12, 12:] += rng.poisson(20, (12, 13))
    of = lm.exchange(b, classes=4, sweeps=50)
    best = likelihood(b, of, 4)
    assert of[24] == 0 and (of[:24] > 0).all()
    for u in range(24):
        for c in (1, 2, 3):
            other = of.copy()
            other[u] = c
            assert likelihood(b, other, 4) <= best + 1e-6


def test_edge_cases(spark):
    docs = make_docs(spark, [None, "", "x y", "x y", "w " * 60_000, "new words"]).withColumn("held_out", F.lit("clash"))
    rows = {r.id: r for r in lm.score(docs, F.col("doc_id") == 5).collect()}
    want = plain_base([(r.doc_id, r.text) for r in docs.collect()], lambda i: i == 5)
    assert all((rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == want[i][:3] for i in want)
    assert all(math.isclose(rows[i].base_score, want[i][3], rel_tol=1e-9) for i in want)
    nothing = lm.score(docs, F.lit(True)).collect()
    assert {r.train_tokens for r in nothing} == {0} and all(math.isfinite(r.score) for r in nothing)
    assert lm.score(docs.limit(0), F.lit(False)).collect() == []
    both = make_docs(spark, [(1, "a b"), (1, "a b"), (1, "c"), (None, "a")])
    assert lm.score(both, F.lit(None).cast("boolean")).count() == 4


def test_frequent_words_are_clustered_at_any_vocabulary_size(spark, monkeypatch):
    monkeypatch.setattr(lm, "PAIRS", 500)
    rng = np.random.default_rng(5)
    kinds = [[f"w{k}x{i:03d}" for i in range(400)] for k in range(3)]  # each kind is followed by the next
    texts = [" ".join(kinds[i % 3][rng.integers(400)] for i in range(60)) for _ in range(600)]
    src = make_docs(spark, texts).select(F.col("text").alias("t"))
    words = materialize(lm.count_words(src), "words")
    m = lm.frequent_words(words)
    assert m.clustered == 1200  # more than SEEDS
    want = Counter()
    unit = {w: int(m.look_up(lm.names_of(pa.array([w.decode()])))[2][0]) for w in [x.encode() for k in kinds for x in k] + [lm.END]}
    for t in texts:
        ws = [lm.END, *t.encode().split(), lm.END]
        want.update((unit[a], unit[b]) for a, b in zip(ws, ws[1:]))
    size = m.end + 1
    got = {(r.unit, x.key): x.n for r in lm.unit_bigrams(src, m).collect() for x in r.near}
    assert got == {**{(a, b): n for (a, b), n in want.items()}, **{(b, a + size): n for (a, b), n in want.items()}}
    dense = np.zeros((size, size))
    for (a, b), n in want.items():
        dense[a, b] = n
    monkeypatch.setattr(lm, "ROUNDS", 0)
    start = likelihood(dense, lm.learn(src, words).classes, lm.CLASSES)
    monkeypatch.undo()
    of = lm.learn(src, words).classes
    assert likelihood(dense, of, lm.CLASSES) > start + 1000 and of[-1] == 0 and (of[:-1] > 0).all()
    # words of one kind share no class with words of another
    held = [{int(of[unit[w.encode()]]) for w in k} for k in kinds]
    assert np.mean([len(a & b) for a, b in zip(held, held[1:])]) <= 1


def test_tokens_are_the_words_of_a_plain_split():
    texts = ["", " ", None, "A b\x1cC\x85d\u2003e É", "  x\t\x0by\x0c\r\nX ", "w", "long " * 5, "\n"]
    names, at, sizes = lm._tokens(pa.array(texts, pa.string()))
    want = [[*(t or "").encode().lower().split(), lm.END] for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    flat = [w.decode() for ws in want for w in ws]
    assert names[at].tolist() == lm.names_of(pa.array(flat)).tolist()
    assert len(set(lm.names_of(pa.array(flat)).tolist())) == len(set(flat))
    sliced = pa.array(["zz", *flat]).slice(1)
    assert lm.names_of(sliced).tolist() == lm.names_of(pa.array(flat)).tolist()
