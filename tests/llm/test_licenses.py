import math
import random
from collections import Counter

from llm_fixtures import make_docs
from pyspark.sql import functions as F

from vaultline.llm import licenses as L

LINES = {n: t for n, t in reversed(L.TEMPLATES)}


def plain_match(texts):
    """Best license per text: dense cosine of every unit with every template."""
    words = [set(L.words_of((t or "").encode())) for t in texts]
    vocab = {w for _, t in L.TEMPLATES for w in L.words_of(t.encode())}
    idf = lambda w: math.log((len(texts) + 1) / (1 + (sum(w in s for s in words) if w in vocab else 0))) + 1

    def vec(b):
        v = {w: n * idf(w) for w, n in Counter(L.words_of(b)).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / norm for w, x in v.items()}

    templates = [(n, vec(t.encode())) for n, t in L.TEMPLATES]
    out = []
    for t in texts:
        scores = [(sum(x * v.get(w, 0) for w, x in tv.items()), n) for u in L.units_of((t or "").encode())
                  for v in [vec(u)] for n, tv in templates]
        best = min(((-round(s, 9), n) for s, n in scores if s >= L.MIN_COSINE), default=None)
        out.append(best and best[1])
    return out


def corpus(rng, n=120):
    words = "the of under license work version software free public copy general this is to any file".split() + [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(n):
        lines = [" ".join(rng.choices(words, k=rng.randrange(1, 15))) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.5:
            t = rng.choice(L.TEMPLATES)[1].split()
            if rng.random() < 0.4:
                t[rng.randrange(len(t))] = "changed"
            lines.insert(rng.randrange(len(lines) + 1), " ".join(t))
        texts.append(rng.choice(["\n", "\n\n"]).join(lines))
    return texts + [None, "", " \n"]


def plain_inherit(rows):
    """{id: (license, from)} by walking up from each file."""
    dirs = {}
    for i, path, own, score in rows:
        if path and own and path.rsplit("/", 1)[-1].upper().startswith(("LICENSE", "COPYING")):
            d = path.rsplit("/", 1)[0] if "/" in path else ""
            dirs.setdefault(d, []).append((-score, own))
    out = {}
    for i, path, own, score in rows:
        if own or path is None:
            out[i] = (own, None)
            continue
        d = path.rsplit("/", 1)[0] if "/" in path else ""
        while d and d not in dirs:
            d = d.rsplit("/", 1)[0] if "/" in d else ""
        out[i] = (min(dirs[d])[1], d) if d in dirs else (None, None)
    return out


def test_own_licenses_against_dense_cosine(spark):
    texts = corpus(random.Random(1))
    docs = make_docs(spark, texts).withColumn("path", F.lit("a/b"))
    got = {r.id: r.own_license for r in L.own_licenses(docs, "doc_id", "path", "text").collect()}
    want = plain_match(texts)
    assert sum(x is not None for x in want) > 30
    assert [got[i] for i in range(len(texts))] == want


def test_inheritance_against_walking_up(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        d = "/".join(rng.choices("abc", k=rng.randrange(0, 5)))
        name = rng.choice(["LICENSE", "license.txt", "COPYING", "x.py", "LICENSES", "y.md"]) if rng.random() < 0.1 else f"f{i}.txt"
        own = rng.choice(list(LINES)) if rng.random() < 0.3 else None
        rows.append((i, f"{d}/{name}" if d else name, own, rng.choice([0.7, 0.8, 1.0]) if own else None))
    rows.append((400, None, None, None))
    df = spark.createDataFrame(rows, "id long, path string, own_license string, own_score double")
    got = {r.id: (r.license, r.inherited_from) for r in L.inherit(df).collect()}
    want = plain_inherit([(i, p and p.replace("LICENSES", "other"), o, s) for i, p, o, s in rows])
    assert got == want and any(f for _, f in want.values())


def test_scan_and_edge_cases(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "p/LICENSE", mit), (2, "p/a/x.py", "code"), (3, "p/a/LICENSE.md", gpl + "\ntail"), (4, "p/a/b/y.py", None),
            (5, "q/z.py", "w " * 60_000 + "\n" + gpl), (6, "q/z2.py", ""), (7, None, mit), (7, None, mit), (8, "/p//./a/w.py", "x"), (9, "top", "x")]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("dir", F.lit("clash")).withColumn("up", F.lit(0))
    got = {r.id: (r.license, r.inherited_from) for r in L.scan(files).collect()}
    assert got == {1: ("MIT", None), 2: ("GPL-3.0", "p/a"), 3: ("GPL-3.0", None), 4: ("GPL-3.0", "p/a"), 5: ("GPL-3.0", None),
                   6: (None, None), 7: ("MIT", None), 8: ("GPL-3.0", "p/a"), 9: (None, None)}
    assert L.scan(files).count() == len(rows)
    assert L.scan(files.limit(0)).collect() == []
