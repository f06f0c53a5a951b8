"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Project a result onto types every engine renders alike.

    Integral decimals -> bigint, other decimals -> double, dates and
    timestamps -> ISO text.  Used only at the registry boundary, so the
    library keeps exact decimal and date types.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("bigint") if t.scale == 0 else c.cast("double")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, (T.FloatType,)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(cols)
