"""Presentation of query results: money and rates as DOUBLE.

Tables keep exact DECIMAL(15,2) / DECIMAL(5,4). Reports present them as DOUBLE,
as the reference's exported report does (its CSV shows ``10000.0`` / ``0.02``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType


def present(df: DataFrame) -> DataFrame:
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        exprs.append(f"CAST({q} AS DOUBLE) AS {q}" if isinstance(f.dataType, DecimalType) else q)
    return df.selectExpr(*exprs)
