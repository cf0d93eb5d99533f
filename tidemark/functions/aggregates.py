"""Mergeable aggregates.

Every window operator of this package takes a list of :class:`Agg`.  An ``Agg`` says what one row
contributes (its *state* columns), how states merge (Spark aggregate functions), and how the result is
read off a merged state.  Because states merge, the same aggregate serves a plain ``groupBy``, a running
``over(...)`` frame, panes of a sliding window, partial sessions, and the state table of a stream; and
every ``groupBy`` gets Spark's map-side combine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Agg:
    """One named aggregate.

    ``row`` maps a suffix to the state column of a single row, ``merge`` builds the aggregate expression of
    each suffix from the state column names, and ``final`` reads the result.
    """

    name: str
    row: dict[str, Column]
    merge: Callable[[dict[str, str]], dict[str, Column]]
    final: Callable[[dict[str, str]], Column]

    @property
    def state(self) -> dict[str, str]:
        return {suffix: f"_st_{self.name}{suffix}" for suffix in self.row}


def _simple(name: str, value: Column, fn: Callable[[str], Column]) -> Agg:
    return Agg(name, {"": value}, lambda s: {"": fn(s[""])}, lambda s: F.col(s[""]))


def order_key(order: Sequence[str]) -> Column:
    """One sortable column for an arrival order; a single column stays plain so that hash aggregation applies."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def count_rows(name: str = "n") -> Agg:
    return Agg(
        name,
        {"": F.lit(1).cast("bigint")},
        lambda s: {"": F.sum(s[""])},
        lambda s: F.coalesce(F.col(s[""]), F.lit(0).cast("bigint")),
    )


def total(col: str, name: str | None = None) -> Agg:
    return _simple(name or f"sum_{col}", F.col(col), F.sum)


def least(col: str, name: str | None = None) -> Agg:
    return _simple(name or f"min_{col}", F.col(col), F.min)


def greatest(col: str, name: str | None = None) -> Agg:
    return _simple(name or f"max_{col}", F.col(col), F.max)


def first_by(col: str, order: Sequence[str], name: str | None = None) -> Agg:
    """Value of the row that arrived first."""
    return Agg(
        name or f"first_{col}",
        {"_o": order_key(order), "_v": F.col(col)},
        lambda s: {"_o": F.min(s["_o"]), "_v": F.min_by(s["_v"], s["_o"])},
        lambda s: F.col(s["_v"]),
    )


def last_by(col: str, order: Sequence[str], name: str | None = None) -> Agg:
    """Value of the row that arrived last."""
    return Agg(
        name or f"last_{col}",
        {"_o": order_key(order), "_v": F.col(col)},
        lambda s: {"_o": F.max(s["_o"]), "_v": F.max_by(s["_v"], s["_o"])},
        lambda s: F.col(s["_v"]),
    )


def top_row(by: str, order: Sequence[str], fields: Sequence[str], name: str = "top") -> Agg:
    """Struct of ``fields`` from the row with the greatest ``by``; the first row in ``order`` wins ties.

    ``order`` must be numeric.  Rows with a null ``by`` never win.
    """
    rank = F.struct(F.col(by).alias("by"), *[(-F.col(c)).alias(f"o{i}") for i, c in enumerate(order)])
    return Agg(
        name,
        {"_o": F.when(F.col(by).isNotNull(), rank), "_v": F.struct(*fields)},
        lambda s: {"_o": F.max(s["_o"]), "_v": F.max_by(s["_v"], s["_o"])},
        lambda s: F.col(s["_v"]),
    )


def joined(col: str, order: Sequence[str], sep: str = "", name: str | None = None) -> Agg:
    """Strings joined in arrival order.  Holds the group's values, so use it where groups are bounded
    (count windows); :func:`tidemark.operators.windows.concat_in_order` is the form for time windows."""
    return Agg(
        name or f"concat_{col}",
        {"": F.array(F.struct(order_key(order).alias("o"), F.col(col).alias("v")))},
        lambda s: {"": F.flatten(F.collect_list(s[""]))},
        lambda s: F.array_join(F.transform(F.array_sort(s[""]), lambda x: x["v"]), sep),
    )


def folded(
    col: str,
    order: Sequence[str],
    start: Column,
    step: Callable[[Column, Column], Column],
    name: str = "folded",
) -> Agg:
    """Left fold in arrival order with a start value and any step, also a non-commutative one.

    Like :func:`joined` it holds the group's values.  A commutative fold should be a plain aggregate instead.
    """
    return Agg(
        name,
        {"": F.array(F.struct(order_key(order).alias("o"), F.col(col).alias("v")))},
        lambda s: {"": F.flatten(F.collect_list(s[""]))},
        lambda s: F.aggregate(F.transform(F.array_sort(s[""]), lambda x: x["v"]), start, step),
    )


def state_names(aggs: Sequence[Agg]) -> list[str]:
    return [c for a in aggs for c in a.state.values()]


def state_columns(aggs: Sequence[Agg]) -> list[Column]:
    """State of a single row, one column per state name."""
    return [col.alias(a.state[suffix]) for a in aggs for suffix, col in a.row.items()]


def merges(aggs: Sequence[Agg]) -> list[tuple[str, Column]]:
    """State names and the aggregate expressions that merge them."""
    return [(a.state[suffix], expr) for a in aggs for suffix, expr in a.merge(a.state).items()]


def final_columns(aggs: Sequence[Agg]) -> list[Column]:
    return [a.final(a.state).alias(a.name) for a in aggs]


def merged(states: DataFrame, keys: Sequence[str], aggs: Sequence[Agg]) -> DataFrame:
    """Merge states per key: partial aggregation, one shuffle of partials, final aggregation."""
    return states.groupBy(*keys).agg(*[expr.alias(n) for n, expr in merges(aggs)])
