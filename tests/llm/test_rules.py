import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_fixtures import DOC_SCHEMA, make_docs
from vaultline.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0d]+")
NORMAL = str.maketrans(rules._FROM, rules._TO)
COLUMNS = ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed", "base_failed", "kept")


def normal(line):
    return " ".join(WORD.findall(line)).translate(NORMAL)


def plain_often(rows):
    """{(host, normalised line)} above both limits, from rows (id, text, host)."""
    found, docs = Counter(), Counter(h for *_, h in rows)
    for _, text, host in rows:
        found.update({(host, normal(x)) for x in (text or "").split("\n") if WORD.search(x)})
    return {k for k, n in found.items() if n > rules.LINE_DOCUMENTS and n > rules.LINE_SHARE * docs[k[0]]}


def plain_rules(rows):
    often, out = plain_often(rows), []
    for i, text, host in rows:
        text = text or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        places = defaultdict(list)
        for p in range(len(words) - 4):
            places[tuple(words[p:p + 5])].append(p)
        covered = {q for ps in places.values() if len(ps) > 1 for p in ps for q in range(p, p + 5)}
        removed = sum(len(WORD.findall(x)) for x in lines if (host, normal(x)) in often)
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        left = len(words) - removed
        out.append((i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
                    len(covered), removed, failed, not failed and left >= 10 and left >= rules.MIN_LEFT * len(words)))
    return out


def judged(df):
    return sorted(map(tuple, rules.judge(df).select(*COLUMNS).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", h, None) for i, t, h in rows], DOC_SCHEMA).repartition(4)


def hosts(rng):
    """Three hosts: boilerplate in all texts of one, in a few of another, one host null."""
    rows = []
    for k in range(90):
        host = ("a", "b", None)[k % 3]
        body = " ".join(f"{rng.choice('qwertz')}{rng.randrange(50)}" for _ in range(rng.randrange(8, 60)))
        extra = {"a": "Accept all cookies %d now, please\t!" % k, "b": "seldom seen here" if k < 12 else "", None: "NULL host line"}[host]
        rows.append((k, f"{body}\n{extra}\n{extra.upper()}" if k % 2 else f"{extra}\n\n{body}", host))
    rows += [(200 + k, "Accept all cookies 42 now, please !\nfew words of its own here", "a") for k in range(3)]
    return rows


ODD = [(900, None, "z"), (901, "", "z"), (902, "  \n\t\x0b\n", None), (None, "one " * 12, None), (None, "one " * 12, None),
       (903, "a b c d e f g h i j", "z"), (903, "a b c d e f g h i j k", "z"), (904, "x y z w v " * 3, "z"), (905, "#*$% &|<>#\n#*$% &|<>#", "z"),
       (906, "é ü  日本 😀 #  a b c d e f g", "z"), (907, " ".join(map(str, range(30_000))) + " 0 1 2 3 4 5", "z"),
       (908, "a a a a a a a a a a a a", "z"), (909, "same line here\r\nsame line here\nsame line here", "z")]


def test_equals_the_plain_rules(spark):
    rows = hosts(random.Random(3)) + ODD
    got = judged(table(spark, rows))
    assert got == sorted(plain_rules(rows), key=str)
    assert {200, 201, 202} <= {r[0] for r in got if not r[7] and not r[8]}  # depleted
    assert sum(r[6] > 0 for r in got) > 50


def test_equals_the_plain_rules_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert judged(docs) == sorted(plain_rules(rows), key=str)


def test_both_limits_must_be_passed(spark):
    text = lambda k, line: " ".join("".join(chr(97 + int(c)) for c in str(1000 * k + j)) for j in range(20)) + "\n" + line
    few = [(k, text(k, "in all ten"), "few") for k in range(10)]
    share = [(100 + k, text(k, "in eleven" if k < 11 else "other"), "many") for k in range(110)]
    more = [(300 + k, text(k, "in twelve of 110" if k < 12 else "other"), "more") for k in range(110)]
    got = {r[0]: r[6] for r in judged(table(spark, few + share + more))}
    assert {i for i, n in got.items() if n} == {*range(111, 210), *range(300, 410)}  # "other" is above both limits


def test_clean_removes_the_lines_and_keeps_all_columns(spark):
    rows = hosts(random.Random(3)) + ODD
    df = table(spark, rows).withColumn("key", F.lit(1)).withColumn("h", F.lit(2)).withColumn("removed", F.lit(3)) \
        .withColumn("words", F.lit(4)).withColumn("t", F.lit(5)).withColumn("n", F.lit(6)).withColumn("host", F.lit(7))
    out = rules.clean(df)
    assert out.columns == df.columns
    often = plain_often(rows)
    want = [(i, "\n".join(x for x in t.split("\n") if not WORD.search(x) or (h, normal(x)) not in often))
            for (i, t, h), r in zip(rows, plain_rules(rows)) if r[-1]]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


def test_empty_table_and_no_python_in_the_plan(spark):
    docs = make_docs(spark, ["a b c"])
    assert rules.judge(docs.limit(0)).count() == 0 and rules.clean(docs.limit(0)).count() == 0
    for df in (rules._measured(docs, F.lit(1), "doc_id", "text", "source"), rules.judge(docs), rules.clean(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop")), plan
