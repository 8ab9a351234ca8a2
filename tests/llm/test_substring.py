import random

import numpy as np
import pytest

from llm_fixtures import make_docs
from pyspark.sql import functions as F

from vaultline.llm import substring
from vaultline.llm.text import Names


def plain(pairs, w):
    """{row: (n_words, removed words, kept)} by comparing windows as tuples."""
    words = [(i, (t or "").encode().split()) for i, t in pairs]
    least = {}
    for i, ws in words:
        for p in range(len(ws) - w + 1):
            if i is not None:
                least[tuple(ws[p:p + w])] = min(i, least.get(tuple(ws[p:p + w]), i))
    out = []
    for i, ws in words:
        gone = {q for p in range(len(ws) - w + 1) if i is not None and least[tuple(ws[p:p + w])] < i for q in range(p, p + w)}
        out.append((i, len(ws), len(gone), b" ".join(x for q, x in enumerate(ws) if q not in gone).decode()))
    return sorted(out, key=str)


def got(docs, **kw):
    rows = substring.remove_repeats(docs, **kw).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    return sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in rows), key=str)


@pytest.mark.parametrize("letters,window", [("ab", 5), ("abcdefgh", 6), ("a", 4), ("abc", 13)])
def test_random_texts_against_plain_windows(spark, letters, window):
    rng = random.Random(window)
    pairs = []
    for i in range(70):
        t = rng.choices(letters, k=rng.randrange(0, 40))
        if pairs and rng.random() < 0.5:
            src = rng.choice(pairs)[1].split()
            a = rng.randrange(len(src) + 1)
            t[3:3] = src[a:a + rng.randrange(30)]
        pairs.append((rng.randrange(1000), " ".join(t)))
    assert got(make_docs(spark, pairs), window=window) == plain(pairs, window)


def test_passages_and_runs(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage, noise = [word() for _ in range(60)], lambda n: [word() for _ in range(n)]
    pairs = [(i, " ".join(noise(rng.randrange(40)) + passage[:rng.randrange(8, 60)] + noise(20))) for i in range(40)]
    pairs += [(100, "the " * 30), (101, "x " + "the " * 50 + "y"), (102, "the " * 12), (103, "a b " * 20), (104, "z " + "a b " * 20)]
    pairs += [(200, " ".join(passage)), (201, " ".join(passage)), (201, " ".join(passage))]
    assert got(make_docs(spark, pairs)) == plain(pairs, 13)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    pairs = [(1, None), (2, ""), (3, " \n"), (4, long), (5, long + " end"), (None, "a " * 20), (6, "a " * 20), (7, "one two"),
             (-3, "é ü " * 9), (1 << 60, "é ü " * 9), (7, "one two")]
    docs = make_docs(spark, pairs).withColumn("id", F.lit("clash")).withColumn("chunk", F.lit(1))
    assert got(docs) == plain(pairs, 13)
    assert got(docs.limit(0)) == []


def test_small_chunks_give_the_same(spark, monkeypatch):
    rng = random.Random(1)
    pairs = [(i, " ".join(rng.choices("abcde", k=30))) for i in range(60)]
    monkeypatch.setattr(substring, "CHUNK_BYTES", 64)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 256)
    assert got(make_docs(spark, pairs), window=5) == plain(pairs, 5)


def test_keys_are_the_same_wherever_their_context_occurs():
    rng = random.Random(3)
    memo, w = Names(), 13
    for _ in range(300):
        inner = rng.choices("aabcdefghijklmnop", k=w)
        seen = []
        for _ in range(3):
            left = rng.choices("abc", k=rng.randrange(6)) + [inner[0]] * rng.randrange(3)
            text = left + inner + [inner[-1]] * rng.randrange(3) + rng.choices("abc", k=rng.randrange(6))
            key, lo, hi, _ = substring.keys_of(memo.of([x.encode() for x in text]), np.zeros(len(text), np.int64), w)
            at = (lo >= len(left)) & (hi <= len(left) + w)
            seen.append(sorted(zip(key[at].tolist(), (lo[at] - len(left)).tolist(), (hi[at] - len(left)).tolist())))
        assert seen[0] == seen[1] == seen[2]
