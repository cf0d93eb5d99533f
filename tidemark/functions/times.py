"""Time helpers.  Event time is a TIMESTAMP column; arithmetic is done in epoch microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text layouts of times in the input lines and in the printed results.
COMPACT = "yyyyMMdd-HHmmss"
SECONDS = "yyyy-MM-dd HH:mm:ss"
MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def ms(duration_ms: int) -> str:
    """Interval text for ``F.window``, ``F.session_window`` and ``withWatermark``."""
    return f"{int(duration_ms)} milliseconds"


def from_millis(col: Column | str) -> Column:
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def as_timestamp(df: DataFrame, col: str) -> DataFrame:
    """Give ``col`` the TIMESTAMP type: zone-less timestamps are read in the session zone, integers as epoch ms."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.TimestampType):
        return df
    if isinstance(kind, T.IntegralType):
        return df.withColumn(col, F.timestamp_millis(F.col(col)))
    return df.withColumn(col, F.col(col).cast("timestamp"))


def text_to_millis(col: Column | str, layout: str = COMPACT) -> Column:
    """Epoch ms of a text time, 0 where it cannot be read."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.unix_millis(F.try_to_timestamp(c, F.lit(layout))), F.lit(0).cast("bigint"))


def millis_to_text(col: Column | str, layout: str = SECONDS) -> Column:
    return F.date_format(from_millis(col), layout)
