import hashlib
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from llm_fixtures import make_docs
from pyspark.sql import functions as F

from vaultline.llm import fingerprints as fp
from vaultline.llm.text import Names


def plain_rows(pairs):
    """(id, n_chars, sha of the edited text) in descending id order, the first following the last."""
    rows = sorted(pairs, key=lambda p: -p[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        n, nxt = len(t), rows[(k + 1) % len(rows)][1]
        new = t[:n - n // 2] + nxt[:n // 2]
        out[i] = (n, hashlib.sha256(new.encode()).hexdigest(), new, nxt)
    return out


def one(text):
    return fp.fingerprint_texts([text.encode()], Names())


def check(got, want):
    assert set(got) == set(want)
    for i, (n, sha, new, nxt) in want.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.edited_fingerprint == fp._hex(one(new))[0]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_documents_against_plain_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.id: r for r in fp.neighbour_fingerprints(docs.repartition(7)).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_rows(rows)
    check(got, want)
    for i, t in rows:
        assert got[i].fingerprint == fp._hex(one(t))[0]
        assert got[i].near_next == fp.likeness(one(t), one(want[i][3]))[0]
    long = [i for i, t in rows if len(t) > 3000 and len(want[i][3]) > 3000]
    assert np.mean([got[i].near_edited for i in long]) > 0.2 > 0.1 > np.median([got[i].near_next for i in long])


@pytest.mark.parametrize("texts", [["only"], ["", ""], ["a b c d", None, "", " \n", "é ü\U0001f600 x", "w " * 60_000, "a b c d"]])
def test_edge_cases(spark, texts):
    docs = make_docs(spark, [(3 * i - 5, t) for i, t in enumerate(texts)]).withColumn("range", F.lit("clash")).withColumn("t", F.lit(0))
    got = {r.id: r for r in fp.neighbour_fingerprints(docs).collect()}
    check(got, plain_rows([(3 * i - 5, t or "") for i, t in enumerate(texts)]))


def test_null_ids_repeated_ids_and_empty(spark):
    docs = make_docs(spark, [(1, "a b"), (1, "c d"), (None, "e f"), (2, "g h"), (2, "g h")])
    assert fp.neighbour_fingerprints(docs).count() == 5
    assert fp.neighbour_fingerprints(docs.limit(0)).collect() == []


def test_equal_substrings_share_interior_phrases():
    rng = random.Random(4)
    words = lambda n: ["".join(rng.choices("abcdefgh", k=4)) for _ in range(n)]
    shared = words(400)
    memo = Names()
    sets = []
    for k in (0, 1, 17):
        sym = memo.of([w.encode() for w in words(k + 50) + shared + words(60)])
        names, _, _ = fp.parse(sym, np.zeros(len(sym), np.int64))
        sets.append(set(names.tolist()))
    own, _, _ = fp.parse(memo.of([w.encode() for w in shared]), np.zeros(400, np.int64))
    inner = own[6:-6].tolist()
    assert len(inner) > 60 and all(set(inner) <= s for s in sets)


def test_labels_differ_from_neighbours_and_phrases_are_short():
    rng = np.random.default_rng(1)
    sym = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    doc = np.sort(rng.integers(0, 9, 5000))
    label = fp._labels(sym, doc)
    assert label.max() < 8 and (label[1:] != label[:-1])[doc[1:] == doc[:-1]].all()
    _, _, at = fp.parse(sym, doc)
    assert np.diff(at).max() <= 16
