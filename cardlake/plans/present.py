"""Engine-neutral rendering of result columns for the cross-engine check.

Spark and DuckDB hand dates, timestamps and decimals to pandas as different
Python types (``date`` vs ``datetime64``, ``Decimal`` vs ``float``, ns vs us).
The registered queries therefore render dates as ``yyyy-MM-dd`` text,
timestamps as ``yyyy-MM-dd HH:mm:ss.ffffff`` text and decimals as doubles;
``plans.oracle`` renders its columns the same way. The library functions
themselves return the real types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def for_check(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_FORMAT)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(cols)
