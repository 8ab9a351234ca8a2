import random

import public_tokenizers
from llm_fixtures import make_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vaultline.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "B", "é", "é", "Σ", "ς", "İ", "ß", "ﬁ", "'s", "'LL", "'", "1", "²", "Ⅷ", "١", "!", "?", "_", "-", " ", "\n",
       "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "᠎", "中", "😀", "<|endoftext|>", "<|startoftext|>",
       "<|", "|>", "the", "ing", "ͅ", "́", "ǅ", "`", " ", "K", "﻿", "　", "\x00", "\x0b", "한", "가"]


def by_library(texts):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    out = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    return out, [t.decode(i, skip_special_tokens=False) for i in out]


def as_ids(b):
    import numpy as np
    return np.frombuffer(b, "<u4").tolist()


def test_random_texts_equal_the_library(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ODD, k=rng.randrange(1, 25))) for _ in range(4000)]
    texts += [None, "", "ab" * 5000, "the" * 3000 + "x", "a" * 200, "word " * 60_000, "same", "same"]
    docs = make_docs(spark, texts).withColumn("ids", F.lit("clash"))
    got = {r.id: r for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    ids, back = by_library(texts)
    for i in range(len(texts)):
        assert as_ids(got[i].ids) == ids[i], texts[i]
        assert got[i].decoded == back[i]


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 50)
    v = bpe.Vocabulary(PATH)
    texts = [" ".join(f"w{i}x{j}" for i in range(20)) for j in range(20)]
    got = [as_ids(v.encode_texts([t])[0]) for t in texts]
    assert got == by_library(texts)[0] and len(v.memo) <= 50


def test_empty_table(spark):
    empty = make_docs(spark, ["x"]).limit(0)
    assert bpe.decode(bpe.encode(empty, PATH), PATH).collect() == []
