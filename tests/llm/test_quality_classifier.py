import numpy as np
import pyarrow.parquet as pq

from conftest import SF_ORACLE
from llm_fixtures import make_docs
from pyspark.sql import functions as F

from vaultline.llm import quality


def test_held_out_accuracy(spark):
    from vaultline.llm.queries import op7
    got = {r.doc_id: r for r in op7(spark, SF_ORACLE).collect()}
    t = pq.read_table(f"{SF_ORACLE}/labels.parquet").to_pydict()
    held = [(got[d], q) for d, q in zip(t["doc_id"], t["quality"]) if got[d].held_out]
    assert len(held) >= 50 and len(got) == 1000
    assert np.mean([r.predicted == q for r, q in held]) >= 0.93
    good, bad = ([r.score for r, q in held if q == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_outside_the_training_fold_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    flipped = labels.withColumn("quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.id: r.score for r in quality.classify(docs, x.where(fold != 0)).collect()} for x in (labels, flipped))
    assert a == b


def test_edge_cases(spark):
    texts = [None, "", " \n", "good plain words here", "BAD!! BAD!! BAD!!", "w " * 60_000, "good plain words here"]
    docs = make_docs(spark, texts).withColumn("quality", F.lit("clash"))
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (6, 1, 1), (None, 1, 0), (5, None, 0), (99, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.id: r.score for r in quality.classify(docs, labels).collect()}
    assert got[0] == got[1] == got[2] and got[3] == got[6] and got[3] > 0.5 > got[4]
    same = quality.classify(docs, labels.where("quality = 1")).collect()
    assert {r.score for r in same} == {1.0}
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(texts)
    assert quality.classify(docs.limit(0), labels).collect() == []


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, quality.DIM))
    y = (x[:, 0] + rng.normal(0, 1.5, 4000) > 0).astype(float)
    net = quality.fit_network(x[:3000], y[:3000])
    p, t = net.scores(x[3000:]), y[3000:]
    for lo, hi in ((0, 0.3), (0.3, 0.7), (0.7, 1)):
        inside = (p >= lo) & (p < hi)
        assert abs(p[inside].mean() - t[inside].mean()) < 0.12
