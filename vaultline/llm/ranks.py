"""Positions of rows inside their groups, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.session import materialize


def same(names: Sequence[str], left: DataFrame, right: DataFrame):
    """Join condition: equal in all these columns, null being equal to null."""
    cond = F.lit(True)
    for c in names:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def positions(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "ranked") -> DataFrame:
    """``rows`` with ``pos``, 0-based in its group by ``order`` (nulls first), and ``n``, the group's rows.

    No group passes through one task: rows are range-partitioned by group and order, so
    a hot group spans many partitions, and only the row counts of (group, partition)
    meet in a window. Rows equal in group and order are placed by a stored number, so
    they spread as well. ``rows`` should be narrow; they are written twice.
    """
    keys = [*group, *order, "_tie"]
    numbered = materialize(rows.withColumn("_tie", F.monotonically_increasing_id()), f"{name}_numbered")
    ranged = materialize(numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_row", F.monotonically_increasing_id()), f"{name}_ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_row", 33))
    inner = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    parts = materialize(parts.withColumn("_before", F.coalesce(F.sum("_count").over(inner), F.lit(0)))
                        .withColumn("n", F.sum("_count").over(Window.partitionBy(*group))), f"{name}_parts")
    joined = ranged.join(parts, same([*group, "_part"], ranged, parts))
    return joined.select(*[ranged[c] for c in rows.columns], (F.col("_before") + F.col("_row") - F.col("_first")).alias("pos"), "n")
