"""Text forms of rows: JSON and delimited payloads for message sinks, and the printed result lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import MILLIS, SECONDS


def json_payload(fields: dict[str, str]) -> Column:
    """JSON object with the given field names taken from the given columns."""
    return F.to_json(F.struct(*[F.col(c).alias(name) for name, c in fields.items()]))


def delimited_payload(columns: Sequence[str], sep: str = ",") -> Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in columns])


def json_messages(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Messages whose key and value are both the JSON of the row."""
    text = json_payload(fields)
    return df.select(text.alias("key"), text.alias("value"))


def line_messages(df: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Messages without a key whose value is the delimited row."""
    return df.select(delimited_payload(columns, sep).alias("value"))


def _at(col: str, layout: str) -> Column:
    return F.date_format(F.col(col), layout)


def range_line(key: str = "key", count: str = "n", first: str = "first_ts", last: str = "last_ts", total: str = "total") -> Column:
    """Printed result of a car window: key, window, element count, time range and sum."""
    # Fixed value: the layout of the line.
    layout = "key:%s,  window:[ %s  ,  %s ), elements count:%d, elements time range:[ %s  ,  %s ]|||%d"
    return F.format_string(
        layout, F.col(key), _at("window_start", SECONDS), _at("window_end", SECONDS), F.col(count),
        _at(first, SECONDS), _at(last, SECONDS), F.col(total),
    )


def comma_line(key: str = "key", count: str = "n", first: str = "first_ts", last: str = "last_ts") -> Column:
    """Printed result of a keyed window: ``(key),count,first,last,start,end``."""
    times = [_at(c, MILLIS) for c in (first, last, "window_start", "window_end")]
    return F.concat_ws(",", F.concat(F.lit("("), F.col(key), F.lit(")")), F.col(count).cast("string"), *times)


def sum_line(key: str = "key", total: str = "total") -> Column:
    """Printed result of a sliding sum."""
    # Fixed value: the layout of the line.
    return F.format_string("key:%s    carSum:  %d", F.col(key), F.col(total))


def click_line(count: str = "n") -> Column:
    """Printed result of a sliding count."""
    # Fixed value: the layout of the line.
    return F.format_string("clickNum:%d", F.col(count))
