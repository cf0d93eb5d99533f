"""Line parsers and tokenizers as column expressions.

A parser turns the text column ``value`` into typed columns.  What happens to a malformed line is the caller's
choice: ``parse`` fails the job, drops such lines, or returns them apart (quarantine).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import text_to_millis

# Field names of the JSON car records.
CAR_JSON = T.StructType([
    T.StructField("carKind", T.StringType()),
    T.StructField("timeStamp", T.LongType()),
    T.StructField("carSum", T.IntegerType()),
    T.StructField("_corrupt", T.StringType()),
])
_CORRUPT = "_corrupt"
# What the pattern \\s stands for.
WHITE_SPACE = " \t\n\x0b\f\r"


def split_like_java(text: Column, pattern: str) -> Column:
    """Split at a character or ``\\s``, without trailing empty parts; leading and inner ones stay, and empty text is one empty part."""
    # Trimming is linear in the text; a regular expression anchored at the end is not.
    stripped = F.rtrim(text, F.lit(WHITE_SPACE if pattern == r"\s" else pattern))
    parts = F.split(stripped, pattern)
    return F.when((stripped == "") & (text != ""), F.array().cast("array<string>")).otherwise(parts)


def _part(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


@dataclass(frozen=True)
class LineParser:
    """``cut`` takes a line apart once, ``fields`` reads typed columns off the parts, ``ok`` says whether the line is well formed."""

    cut: Callable[[Column], Column]
    fields: Callable[[Column], dict[str, Column]]
    ok: Callable[[Column, dict[str, Column]], Column]


def _by(pattern: str) -> Callable[[Column], Column]:
    return lambda line: split_like_java(line, pattern)


def _all_present(_: Column, fields: dict[str, Column]) -> Column:
    good = F.lit(True)
    for c in fields.values():
        good = good & c.isNotNull()
    return good


def _car_text(p: Column) -> dict[str, Column]:
    return {"car_kind": _part(p, 0), "ts_ms": _part(p, 1).try_cast("bigint"), "car_sum": _part(p, 2).try_cast("int")}


def _car_json(j: Column) -> dict[str, Column]:
    return {"car_kind": j["carKind"], "ts_ms": j["timeStamp"], "car_sum": j["carSum"]}


def _keyed(p: Column) -> dict[str, Column]:
    return {"key": _part(p, 0), "ts_ms": _part(p, 1).try_cast("bigint")}


def _counted(p: Column) -> dict[str, Column]:
    return {
        "key": _part(p, 0), "n": _part(p, 1).try_cast("int"), "time": _part(p, 2), "ts_ms": text_to_millis(_part(p, 2)),
    }


def _person(p: Column) -> dict[str, Column]:
    return {"name": _part(p, 0), "age": _part(p, 1), "sexy": _part(p, 2)}


def _job(p: Column) -> dict[str, Column]:
    return {"name": _part(p, 0), "job": _part(p, 1)}


def _telemetry(p: Column) -> dict[str, Column]:
    return {
        "id": _part(p, 0).try_cast("int"), "speed": _part(p, 1).try_cast("int"),
        "distance": _part(p, 2).try_cast("double"), "ts_ms": _part(p, 3).try_cast("bigint"),
    }


def _edit_json(j: Column) -> dict[str, Column]:
    return {"user": j["user"], "byte_diff": j["byteDiff"]}


def _inside_brackets(line: Column) -> Column:
    return F.substring(line, F.lit(2), F.greatest(F.length(line) - 2, F.lit(0)))


CAR_TEXT = LineParser(_by("@"), _car_text, _all_present)
# Missing JSON fields are null by design; only text that is no JSON object is malformed.
CAR_JSON_LINE = LineParser(lambda line: F.from_json(line, CAR_JSON, {"columnNameOfCorruptRecord": _CORRUPT}), _car_json,
                           lambda j, f: j.isNotNull() & j[_CORRUPT].isNull())
KEYED = LineParser(_by(","), _keyed, _all_present)
# A line counts with exactly three parts; an unreadable time is 0, not an error.
COUNTED = LineParser(_by(","), _counted, lambda p, f: (F.size(p) == 3) & f["n"].isNotNull())
PERSON = LineParser(_by(","), _person, _all_present)
JOB = LineParser(_by(r"\s"), _job, _all_present)
TELEMETRY = LineParser(lambda line: split_like_java(_inside_brackets(line), ","), _telemetry, _all_present)
EDIT_JSON = LineParser(lambda line: F.from_json(line, "user string, byteDiff bigint"), _edit_json, _all_present)


@dataclass(frozen=True)
class Parsed:
    rows: DataFrame
    bad: DataFrame | None = None


def parse(df: DataFrame, parser: LineParser, mode: str = "fail", value: str = "value") -> Parsed:
    """Replace the text column by the parser's fields; other columns stay.

    ``fail`` raises when a malformed line is met, ``drop`` leaves such lines out, ``quarantine`` returns them, as text, in ``bad``.
    """
    if mode not in ("fail", "drop", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    line, parts = F.col(value), F.col("_parts")
    fields = parser.fields(parts)
    ok = F.coalesce(parser.ok(parts, fields), F.lit(False))
    others = [c for c in df.columns if c != value]
    if mode == "fail":
        ok = ok | F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce(line, F.lit("null")))).cast("boolean")
    # As a generator's output the parts are computed once per line; the optimizer would copy a plain column into each use.
    cut = df.select("*", F.explode(F.array(parser.cut(line))).alias("_parts"))
    good = cut.where(ok).select(*others, *[c.alias(n) for n, c in fields.items()])
    return Parsed(good, cut.where(~ok).select(*df.columns) if mode == "quarantine" else None)


def space_tokens(text: Column | str) -> Column:
    """Tokens between single spaces, case kept.  Trailing empty tokens vanish, others stay; an empty line is one empty token."""
    return split_like_java(F.col(text) if isinstance(text, str) else text, " ")


def word_tokens(text: Column | str) -> Column:
    """Lower-case tokens of ASCII word characters, none empty."""
    line = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(line), r"\W+"), "")


def metres_per_second(km_per_hour: Column) -> Column:
    return km_per_hour / F.lit(3.6)


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
