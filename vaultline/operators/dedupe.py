"""Keep-latest deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first row under ``order`` (give DESC columns for "latest").

    ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit before the
    shuffle, so a hot key contributes at most one row per map partition to the
    exchange — the hot-key case is pre-reduced map-side, not sent whole to one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
