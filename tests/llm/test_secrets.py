import random
import re

from llm_fixtures import make_docs
from pyspark.sql import functions as F

from vaultline.llm import secrets


def plain_base(text):
    """The rules as stated, on code points."""
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|"""
        r"""(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
        if len(m.group(2)) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [s for *_, s in sorted(out)]


def corpus(rng):
    words = ["the", "thing", "configuration", "international", "ization", "getElementsBy", "héß", "straße"]
    texts = []
    for _ in range(300):
        w = rng.choices(words, k=40)
        w[5] = rng.choice(["token = \"%040x\"" % rng.getrandbits(160), "AKIA" + "".join(rng.choices("ABCDEFGHIJ234567", k=16)),
                           "x", "password:abc", "secret=token:abcdefgh", "ſecret=abcdefgh", "api_key='%016x'" % rng.getrandbits(64)])
        texts.append(" ".join(w))
    return texts


def found(spark, texts, ratio):
    rows = secrets.find(make_docs(spark, texts), ratio).collect()
    return {r.id: [f"{s.kind}:{s.start}:{s.end}" for s in r.spans] for r in rows}


def test_base_spans_against_plain_rules(spark):
    rng = random.Random(1)
    bits = ["token", "TOKEN", "api_key", "apikey", "=", ":", " ", "\"", "'", "AKIA", "AKIAAKIA", "ABCDEFGH12345678", "é",
            "0123456789abcdef", "deadbeef", "secret", "passwd", "abc", "-", ".", "K", "ſ"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 30))) for _ in range(400)] + corpus(rng) + [None, ""]
    docs = make_docs(spark, texts)
    got = found(spark, texts, secrets.fit(secrets.corpus_counts(docs)))
    for i, t in enumerate(texts):
        assert [s for s in got[i] if not s.startswith("markov")] == plain_base(t or ""), t


def test_markov_finds_random_strings_and_leaves_identifiers(spark):
    rng = random.Random(2)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rnd = ["see " + "".join(rng.choices(alnum, k=40)) + " here" for _ in range(30)]
    plain = ["the internationalizationconfiguration thing", "configurationthingthethingconfiguration", "the" * 20]
    texts = corpus(rng) + rnd + plain
    docs = make_docs(spark, texts)
    got = found(spark, texts, secrets.fit(secrets.corpus_counts(docs)))
    n = len(texts) - len(rnd) - len(plain)
    assert all(got[i] == ["markov:4:44"] for i in range(n, n + len(rnd)))
    assert all(got[i] == [] for i in range(n + len(rnd), len(texts)))


def test_labelled_samples_train_the_models(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choices("abcdef0123456789", k=32)), 1) for _ in range(200)] + [("configuration", 0), ("thing", 0)] * 50
    rows += [(None, 1), ("", 0), ("x", None)]
    ratio = secrets.fit(secrets.sample_counts(spark.createDataFrame(rows, "value string, is_secret int")))
    assert [s[2] for s in secrets.all_spans(b"q " + b"F3xQ9zK1w7R5t0Yp2LmB8vC4" + b" q", ratio)] == ["markov"]
    assert secrets.all_spans(b"configurationconfiguration", ratio) == []


def test_redaction_and_edge_cases(spark):
    ratio = secrets.fit(secrets.corpus_counts(make_docs(spark, corpus(random.Random(4)))))
    texts = ["é token = \"0123456789abcdef0123456789abcdef\" ü", None, "", "clean", "w " * 60_000 + "password: hunter22"]
    docs = make_docs(spark, texts).withColumn("spans", F.lit(1))
    out = {r.doc_id: r for r in secrets.redact(docs, ratio).collect()}
    assert out[0].text == "é token = \"[SECRET]\" ü" and out[1].text is None and out[2].text == "" and out[3].text == "clean"
    assert out[4].text.endswith("password: [SECRET]") and out[0].spans == 1
    empty = make_docs(spark, ["x"]).limit(0)
    assert secrets.find(empty, secrets.fit(secrets.corpus_counts(empty))).collect() == []


def test_ordinary_long_runs_stay_and_secrets_beside_them_are_found(spark):
    rng = random.Random(6)
    plain = ["=" * 24, "-" * 22, "some/path/to/the/file/name", "user_account_settings_id_42", "THE_QUICK_BROWN_FOX_JUMPS",
             "getElementsByTagNameAndClass", "MAX_BUFFER_SIZE_IN_BYTES_2", "2024-01-02-03-04-05-06-07",
             "/usr/local/lib/python3/site-packages", "src/main/java/org/apache/spark/sql", "AbstractSingletonProxyFactoryBean"]
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    value = lambda: "".join(rng.choices(alnum, k=40))
    rnd = [value(), "some/path/to/the/file/" + value(), "".join(rng.choices(alnum + "+/", k=64)), "".join(rng.choices(alnum + "-_", k=43))]
    ratio = secrets.fit(secrets.corpus_counts(make_docs(spark, corpus(rng))))
    docs = make_docs(spark, ["see " + x + " here" for x in plain + rnd])
    got = {r.doc_id: r.text for r in secrets.redact(docs, ratio).collect()}
    assert [got[i] for i in range(len(plain))] == ["see " + x + " here" for x in plain]
    assert all(got[len(plain) + i] == "see [SECRET] here" for i in range(len(rnd)))
