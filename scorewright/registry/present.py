"""Presentation step shared by all registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
    TimestampNTZType, TimestampType,
)

_NUMERIC = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)
_TEMPORAL = (DateType, TimestampType, TimestampNTZType)


def present(df: DataFrame) -> DataFrame:
    """Numbers -> double, dates/timestamps/booleans -> text; everything else unchanged.

    One projection on top of the plan; it does not change what is computed.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _NUMERIC) and not isinstance(f.dataType, DoubleType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, BooleanType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, _TEMPORAL):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
