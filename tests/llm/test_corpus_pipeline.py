import hashlib

import public_tokenizers
import pytest

import corpus_pipeline as cp
from conftest import SF_ORACLE
from llm_fixtures import make_docs
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

from vaultline.llm import decontam, secrets
from vaultline.session import materialize


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage on the whole test table."""
    docs, out = spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), []
    for name, stage in cp.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF_ORACLE), "test_stage")
        out.append(({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in docs.collect()}, docs.columns))
    return out


def test_columns(stages):
    assert all(s[2] == ["doc_id", "text", "lang", "source", "n_chars"] for s in stages[:-1])


def test_quality_stage_is_the_operators_decision(spark, stages):
    from vaultline.llm.queries import op7
    accepted = {r.doc_id for r in op7(spark, SF_ORACLE).collect() if r.predicted == 1}
    before, after, _ = stages[0]
    assert set(after) == accepted and 0.7 * len(before) < len(after) < len(before)


def test_near_dedup_stage(stages):
    before, after, _ = stages[1]
    ids = sorted(before)
    roots = plain_components(ids, [plain_fingerprint(before[i].text) for i in ids])
    assert set(after) == set(roots) and len(after) < len(before)


def test_decontamination_stage(spark, stages):
    before, after, _ = stages[2]
    items = [" " + " ".join(x.decode() for x in decontam.tokens(r.text.encode())) + " "
             for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()]
    leaks = {i for i, r in before.items()
             if any(x in " " + " ".join(w.decode() for w in decontam.tokens(r.text.encode())) + " " for x in items)}
    assert leaks and set(after) == set(before) - leaks


def test_secret_stage(stages):
    before, after, _ = stages[3]
    assert set(after) == set(before)
    assert not any(secrets.base_spans(r.text.encode()) for r in after.values())
    hit = [i for i, r in before.items() if secrets.base_spans(r.text.encode())]
    assert hit and all(after[i].text != before[i].text and after[i].n_chars == len(after[i].text) for i in hit)
    assert all(after[i] == before[i] for i in before if i not in hit)


def test_encoding_stage(stages):
    before, after, _ = stages[4]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    assert set(after) == set(before)
    for i, r in after.items():
        ids = t.encode(before[i].text, add_special_tokens=False).ids
        raw = b"".join(k.to_bytes(4, "little") for k in ids)
        assert (r.n_tokens, bytes(r.ids), r.ids_sha256) == (len(ids), raw, hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_equals_the_stages(spark, stages):
    got = {r.doc_id: r.ids_sha256 for r in cp.run(spark, SF_ORACLE).collect()}
    assert got == {i: r.ids_sha256 for i, r in stages[-1][1].items()}


def test_stages_take_odd_rows(spark):
    passage = spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").first().text
    pairs = [(1, None), (2, ""), (3, "the plain words are here"), (3, "the plain words are here"), (None, "x"), (4, passage),
             (5, "w " * 60_000 + 'token = "0123456789abcdef0123456789abcdef"')]
    docs = make_docs(spark, pairs)
    for name, stage in cp.STAGES[1:]:
        docs = materialize(stage(spark, docs, SF_ORACLE), "odd")
    assert sorted(r.doc_id for r in docs.collect() if r.doc_id is not None) == [1, 3, 5]
    for name, stage in cp.STAGES:
        assert stage(spark, make_docs(spark, ["x"]).limit(0), SF_ORACLE).collect() == []
