"""vaultline — a Spark-native medallion pipeline for dirty account and customer files.

Layers: raw (append-only, lineage) → structured (cleansed, deduplicated, upserted)
→ curated (dimensions + tiered-interest fact) → access (report, CSV export).
Every transformation is a pure function over DataFrames; storage lives in
``vaultline.sinks``.
"""

from vaultline.tariff import DEFAULT_TARIFF, Tariff

__all__ = ["DEFAULT_TARIFF", "Tariff"]
