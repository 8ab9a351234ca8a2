"""Report export (CSV) and summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.session import materialize
from vaultline.sources.landing import CSV_TEXT


def summary_statistics(report: DataFrame) -> DataFrame:
    """One aggregate pass: row count, balance / interest / new-balance totals, mean rate.

    Sums stay DECIMAL (exact) and are presented as DOUBLE at the end.
    """
    return report.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("original_balance").cast("double").alias("total_original_balance"),
        F.sum("annual_interest").cast("double").alias("total_annual_interest"),
        F.sum("new_balance").cast("double").alias("total_new_balance"),
        # a mean of doubles depends on summation order in its last bits: report 10 decimals
        F.round(F.avg(F.col("interest_rate").cast("double")), 10).alias("avg_interest_rate"),
    )


def export_csv(df: DataFrame, path: str, order: Sequence[str], single_file: bool = True) -> int:
    """Write the report as CSV with a header, ordered by ``order``; returns the row count.

    ``single_file=True`` writes one file with one task, whatever the size; ``False``
    range-partitions on the order keys: every task writes its own key range and the part
    files, read in name order, are globally sorted. The report is computed once (stored,
    then counted, sorted and written from there). Nothing is written for an empty report.
    """
    stored = materialize(df, "report")
    n = stored.count()
    if n == 0:
        return 0
    ordered = stored.coalesce(1).sortWithinPartitions(*order) if single_file else stored.orderBy(*order)
    ordered.write.mode("overwrite").options(**CSV_TEXT).option("header", True).csv(path)
    return n
