"""The form in which registered queries return their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    """Timestamps and dates as fixed-width text, decimals as doubles, audit stamps left out."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in ("_dbt_processed_at", "_silver_updated_at", "_gold_processed_at"):
            continue
        if isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)
