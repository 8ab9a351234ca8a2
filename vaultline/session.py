"""SparkSession helpers and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings every vaultline job wants; a cluster's own defaults win where set.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "vaultline",
                  work_root: str | None = None) -> SparkSession:
    """A session with the settings above where the cluster sets none.

    ``master`` and ``shuffle_partitions`` are set only if given. ``work_root`` is the
    shared folder for intermediate tables where ``spark.checkpoint.dir`` is unset.
    """
    from pyspark import SparkConf

    given = SparkConf()
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if work_root and not given.contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", work_root)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session (tests, a laptop) gets a folder of its own when none is
    set; on a cluster a machine-local folder would not survive executor loss, so an
    unset setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(intermediate tables and checkpoints are written there)")
        current = tempfile.mkdtemp(prefix="vaultline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "vaultline-work", f"{name}-{uuid.uuid4().hex[:12]}")
    return path


def at_once(*steps):
    """Run independent steps (callables that start Spark jobs) side by side; their results in order."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


def clear_work(spark: SparkSession) -> None:
    """Remove this session's intermediate tables; call it when a run's results are stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(ensure_checkpoint_dir(spark), "vaultline-work"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like a reliable checkpoint (survives executor loss) but computes the
    input once, and later reads get Parquet statistics (filter pushdown, pruning).
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
