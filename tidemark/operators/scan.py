"""Ordered running aggregates that survive hot keys.

``Window.partitionBy(key).orderBy(arrival)`` sorts a whole key in one task.  That is the right plan while every
key fits a task, and it is what :func:`scan` uses then.  For keys above a row limit the rows are cut into
arrival ranges.  Each (key, range) gets a total (map-side combined), the totals are prefix-summed per key, and each
range starts from its prefix, which enters the range's frame as one extra first row.  So
no task ever sorts more than a range, and the data is shuffled once in either case.  The totals are summed as a
tree: ranges in blocks of about the square root of their number, then the blocks, so no task sees all ranges of a key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import Agg, final_columns, merged, merges, state_columns, state_names, total
from tidemark.sources.staging import staged

# A group of at most this many rows may be sorted by one task; the session setting overrides the number.
HOT_ROWS = 1_000_000
HOT_ROWS_SETTING = "spark.tidemark.hotRows"
# A prefix over more ranges than this goes through blocks of ranges.
FLAT = 64
BUCKET = "_bucket"
# Below every value of a part.
NULL = -(2.0**53)


# A double has every whole number below this.
EXACT = 2**53
# A cell that is cut again is cut into at least so many.
FINE = 64


def _whole(kind: T.DataType, c: Column) -> Column | None:
    """Types that are whole numbers of 64 bits at most, as such."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    return c.cast("int").cast("bigint") if isinstance(kind, T.BooleanType) else None


def _parts(kind: T.DataType, c: Column, octets: int, large: bool) -> list[Column]:
    """Doubles that, compared one after the other, order rows as ``c`` does (null first).

    Each is exact: two rows that agree in all parts have the same value, so that only then the next order column decides.
    ``octets`` is the length of the longest text; ``large``: some whole number is not exact as a double.
    """
    whole = _whole(kind, c)
    if whole is not None:
        parts = [F.shiftright(whole, 11), whole.bitwiseAND(F.lit(2047).cast("bigint"))] if large else [whole]
    elif isinstance(kind, T.StringType):
        raw = c.cast("binary")  # texts are ordered by their bytes
        steps = [F.conv(F.rpad(F.hex(F.substring(raw, at, 6)), 12, "0"), 16, 10) for at in range(1, octets + 1, 6)]
        parts = [*steps, F.octet_length(c)]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        finite = ~F.isnan(c) & (F.abs(c) < math.inf)
        # The two zeros are one value in Spark's order.
        parts = [F.when(finite, 0.0).when(F.isnan(c), 2.0).when(c > 0, 1.0).when(c < 0, -1.0),
                 F.when(finite & (c != 0), c.cast("double")).otherwise(0.0)]
    elif isinstance(kind, T.DecimalType):
        parts, rest = [], c
        for power in (30, 15, 0, -15, -30):
            if -kind.scale < power < kind.precision - kind.scale and kind.precision > 15:
                low = rest % F.lit(Decimal(10) ** power)
                parts, rest = [*parts, rest - low], low
        parts = [*parts, rest]
    else:
        raise TypeError(f"order columns must be numbers, booleans, dates, times or texts, not {kind.simpleString()}")
    return [F.coalesce(x.cast("double"), F.lit(NULL)) for x in parts]


@dataclass(frozen=True)
class Split:
    """How hot groups are cut into ranges, by cells of their order values.

    ``roots`` has the hot keys, each with the least and greatest first part of its order, and into how many cells of equal width
    that stretch is cut (without keys it is one tuple).  A cell with too many rows is cut again between its own least and
    greatest value; one that holds a single value is cut by the next part of the order: ``opened`` has these cells, one
    table for each level.  ``cells`` numbers the ranges then: cells in order, so many rows each.  With one level, cells are ranges.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    parts: tuple[Column, ...]
    roots: DataFrame | tuple[float, float, int]
    opened: tuple[DataFrame, ...] = ()
    cells: DataFrame | None = None
    ranges: int = 1
    # Does some value of the first order column fill a range alone?
    heavy: bool = False
    # The parts that cut the cells of each level, from and to.
    cut_by: tuple[tuple[int, int], ...] = ((0, 0),)
    # How many parts the first order column has.
    first_parts: int = 1

    def by_first_column(self) -> Split:
        """The same without cutting equal values of the first order column: all their cells get the least number."""
        if not self.heavy:
            return self
        depth, numbered, number = len(self.opened), self.cells, F.col("_number")
        digits = [f"_d{i}" for i in range(depth + 1)]
        for i in reversed(range(depth)):
            # Under a cell that is cut by another column than the first; the shallowest such cell is the value.
            own = digits[:i + 1]
            under = self.opened[i].where(F.col("_at") >= self.first_parts).select(*self.keys, *own, F.lit(True).alias("_in"))
            least = self._look_up(self.cells, under, own).where("_in").groupBy(*self.keys, *own).agg(F.min("_number").alias(f"_least{i}"))
            numbered = self._look_up(numbered, least, own)
            number = F.coalesce(F.col(f"_least{i}"), number)
        return replace(self, cells=staged(numbered.select(*self.keys, *digits, number.alias("_number"))))

    def _same(self, names: Sequence[str], digits: Sequence[str] = ()) -> Column:
        same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(self.keys, names)] + [F.col(d) == F.col(f"_cell{d}") for d in digits]
        return reduce(lambda a, b: a & b, same, F.lit(True))

    def _look_up(self, df: DataFrame, table: DataFrame, digits: Sequence[str]) -> DataFrame:
        names = [f"_hot_{i}" for i in range(len(self.keys))]
        found = table.withColumnsRenamed({**dict(zip(self.keys, names)), **{d: f"_cell{d}" for d in digits}})
        # Spark broadcasts the table if it is small, and splits the hot keys' rows if it is not.
        return df.join(found, self._same(names, digits), "left").drop(*names, *[f"_cell{d}" for d in digits])

    def part(self, level: int, shift: int = 0) -> Column:
        """The part that cuts the cell of a row (``shift``: the one so many after it); null where there is none."""
        first, last = self.cut_by[level]
        some = [i for i in range(first, last + 1) if 0 <= i + shift < len(self.parts)]
        return reduce(lambda rest, i: F.when(F.col("_at") == i, self.parts[i + shift]).otherwise(rest), some, F.lit(None).cast("double"))

    def _digit(self, level: int) -> Column:
        """The cell of a row inside the cell whose ``_lo`` to ``_hi`` is cut into ``_pieces``; null where nothing is cut.

        Rows that were not there when the split was planned find their place too: 0 and ``_pieces`` + 1 are the rows below
        and above the single value of a cell that is cut by the next part.
        """
        x, before = self.part(level), self.part(level, -1)
        # In quarters, so that differences stay finite; what is too small for that is parted in two.
        at, lo, hi, last = x / 4, F.col("_lo") / 4, F.col("_hi") / 4, F.col("_pieces") - 1
        step = F.greatest(F.lit(0), F.least(F.floor((at - lo) / (hi - lo) * F.col("_pieces")), last))
        inside = F.when(hi > lo, step).when((F.col("_hi") > F.col("_lo")) & (x > F.col("_lo")), last).otherwise(0) + 1
        return F.when(before < F.col("_pin"), 0).when(before > F.col("_pin"), F.col("_pieces") + 1).when(
            F.col("_pieces").isNotNull(), inside).cast("bigint")

    def placed(self, df: DataFrame) -> DataFrame:
        """Add the cell numbers ``_d0``, ``_d1``, ... (null for rows of ordinary groups, 0 below a cell that is not cut again)
        and the columns of the last level's cell."""
        if isinstance(self.roots, tuple):
            lo, hi, pieces = self.roots
            df = df.withColumns({"_at": F.lit(0), "_lo": F.lit(lo), "_hi": F.lit(hi), "_pieces": F.lit(pieces).cast("bigint"),
                                 "_pin": F.lit(None).cast("double")})
        else:
            df = self._look_up(df, self.roots, [])
        df = df.withColumn("_d0", self._digit(0))
        for i, table in enumerate(self.opened):
            df = self._look_up(df.drop(*CELL), table, [f"_d{j}" for j in range(i + 1)])
            df = df.withColumn(f"_d{i + 1}", F.when(F.col("_d0").isNotNull(), F.coalesce(self._digit(i + 1), F.lit(0))))
        return df

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the range number: 0 for rows of ordinary groups, else a number that grows with the order."""
        digits = [f"_d{i}" for i in range(len(self.opened) + 1)]
        df = self.placed(df).drop(*CELL)
        number = F.col("_d0")
        if self.cells is not None:
            df = self._look_up(df, self.cells, digits)
            number = F.col("_number")
        return df.withColumn(BUCKET, F.coalesce(number, F.lit(0).cast("bigint"))).drop(*digits, "_number")


CELL = ("_at", "_lo", "_hi", "_pieces", "_pin")


def plan_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot_rows: int | None = None,
    buckets: int | None = None,
) -> Split | None:
    """Look for groups too large for one task; None if there are none.

    Runs one counting job (map-side combined; rows, least and greatest order value per key) and, only if hot groups exist, one
    more for each level of cells, usually one in all.  Hot is
    what holds more than ``hot_rows`` rows; the list stays a DataFrame.  Without keys all rows form one group, which is
    always cut.  Order columns of a type that cannot be cut are refused whether or not a group is hot.

    ``buckets``, the number of ranges asked for, follows the hot rows: at least the shuffle parallelism, and enough that a range
    holds about ``hot_rows`` rows.  Of a key that holds ``s`` of the ``buckets`` shares of the hot rows at most ``2 s + 2``
    ranges are made, none with twice the rows of a share unless the order has equal rows.
    """
    kinds = {c: df.schema[c].dataType for c in order}
    for col in order:
        _parts(kinds[col], F.col(col), 1, True)
    conf = df.sparkSession.conf
    hot_rows = hot_rows or int(conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))
    facts = {"_n": F.count(F.lit(1)), "_min": F.min(order[0]), "_max": F.max(order[0])}
    for i, col in enumerate(order):
        number = _whole(kinds[col], F.col(col))
        if number is not None:
            facts |= {f"_least_{i}": F.min(number), f"_most_{i}": F.max(number)}
        elif isinstance(kinds[col], T.StringType):
            facts[f"_most_{i}"] = F.max(F.octet_length(col))
    counts = df.groupBy(*keys).agg(*[value.alias(name) for name, value in facts.items()])
    large = counts.where(F.col("_n") > hot_rows) if keys else counts
    over = {"_n": F.sum, "_min": F.min, "_max": F.max}
    most = large.agg(*[over.get(n, F.min if n.startswith("_least") else F.max)(n).alias(n) for n in facts]).first().asDict()
    size = most["_n"] or 0
    if keys and not size:
        return None
    parts, column = [], []
    for i, col in enumerate(order):
        top = most.get(f"_most_{i}") or 0
        own = _parts(kinds[col], F.col(col), top, max(top, -(most.get(f"_least_{i}") or 0)) >= EXACT)
        parts += own
        column += [i] * len(own)
        if i == 0:
            ends = [_parts(kinds[col], F.col(c), top, len(own) > 1)[0].alias(n) for c, n in (("_min", "_lo"), ("_max", "_hi"))]
    if buckets is None:
        parallelism = max(2, int(conf.get("spark.sql.shuffle.partitions")))
        buckets = max(parallelism, math.ceil(size / hot_rows))
    share = max(1, math.ceil(size / buckets))
    pieces = (2 * F.ceil(F.col("_n") / share)).cast("bigint")
    if keys:
        roots = staged(large.select(*keys, F.lit(0).alias("_at"), *ends, pieces.alias("_pieces"), F.lit(None).cast("double").alias("_pin")))
    else:
        stretch = large.select("_n", *ends).first()
        roots = (stretch["_lo"], stretch["_hi"], 2 * math.ceil(max(size, 1) / share))
    split = Split(tuple(keys), tuple(order), tuple(parts), roots, ranges=2 * buckets + 2, first_parts=column.count(0))
    rows = df.select(*dict.fromkeys([*keys, *order]))
    counted = []
    while True:
        digits = [f"_d{i}" for i in range(len(split.opened) + 1)]
        x, following = split.part(len(split.opened)), split.part(len(split.opened), 1)
        found = split.placed(rows).where(F.col("_pieces").isNotNull()).groupBy(*keys, *digits, "_at").agg(
            F.count(F.lit(1)).alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi"),
            F.min(following).alias("_next_lo"), F.max(following).alias("_next_hi"))
        found = staged(found) if split.opened else found
        again = _cut_again(found, [*keys, *digits], share)
        first, deepest = again.agg(F.min("_at"), F.max("_at")).first()
        if deepest is not None and not split.opened:
            found = staged(found)
            again = _cut_again(found, [*keys, *digits], share)
        counted.append(found)
        if deepest is None:
            break
        split = replace(split, opened=(*split.opened, again), cut_by=(*split.cut_by, (first, deepest)),
                        heavy=split.heavy or column[deepest] > 0)
    if not split.opened:
        return split
    cells = _number_cells(split, counted, share)
    return replace(split, cells=cells, ranges=size // share + 1)


def _cut_again(found: DataFrame, names: Sequence[str], share: int) -> DataFrame:
    """The cells that hold more than a share and can be cut: by the same part, or by the next one if all rows agree in it."""
    one = F.col("_lo") == F.col("_hi")
    pieces = F.greatest(2 * F.ceil(F.col("_n") / share), F.lit(FINE)).cast("bigint")
    return found.where((F.col("_n") > share) & (~one | F.col("_next_lo").isNotNull())).select(
        *names, (F.col("_at") + one.cast("int")).alias("_at"),
        F.when(one, F.col("_next_lo")).otherwise(F.col("_lo")).alias("_lo"),
        F.when(one, F.col("_next_hi")).otherwise(F.col("_hi")).alias("_hi"), pieces.alias("_pieces"), F.when(one, F.col("_lo")).alias("_pin"))


def _number_cells(split: Split, counted: list[DataFrame], share: int) -> DataFrame:
    """Every cell that is not cut again, with the number of its range: the rows before it in shares, from 1."""
    keys, depth = list(split.keys), len(split.opened)
    digits = [f"_d{i}" for i in range(depth + 1)]
    # All cells of a cut one, also those without rows: other rows may fall there.
    if isinstance(split.roots, tuple):
        tables = [counted[0].sparkSession.range(1).select(F.lit(split.roots[2]).cast("bigint").alias("_pieces"))]
    else:
        tables = [split.roots.select(*keys, "_pieces")]
    tables += [t.select(*keys, *digits[:i + 1], "_pieces") for i, t in enumerate(split.opened)]
    whole = None
    for i, table in enumerate(tables):
        own = digits[:i + 1]
        every = table.withColumn(own[-1], F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") + 1)))
        every = split._look_up(every, counted[i].select(*keys, *own, "_n"), own)
        if i < depth:
            cut = split.opened[i].select(*keys, *own, F.lit(True).alias("_cut"))
            every = split._look_up(every, cut, own).where(F.col("_cut").isNull())
        every = every.withColumns({d: F.lit(0).cast("bigint") for d in digits[i + 1:]})
        every = every.select(*keys, *digits, F.coalesce("_n", F.lit(0).cast("bigint")).alias("_n"))
        whole = every if whole is None else whole.unionByName(every)
    whole = staged(whole)
    rows = total("_n", "_before")
    levels, states = ["_path"], whole.select("*", F.struct(*digits).alias("_path"), *state_columns([rows]))
    if split.ranges > FLAT:
        levels = [x for d in digits for x in (f"_block{d}", d)]
        states = states.withColumns({f"_block{d}": F.floor(F.col(d) / math.isqrt(split.ranges)) for d in digits})
    before = prefix(states, keys, levels, [rows])
    before = before.select(*keys, *[F.col(f"_path.{d}") if levels == ["_path"] else d for d in digits], *final_columns([rows]))
    numbered = split._look_up(whole, before, digits)
    number = F.floor(F.coalesce("_before", F.lit(0).cast("bigint")) / F.lit(share)).cast("bigint") + 1
    return staged(numbered.select(*keys, *digits, number.alias("_number")))


def prefix(states: DataFrame, group: Sequence[str], digits: Sequence[str], aggs: Sequence[Agg], reverse: bool = False) -> DataFrame:
    """For each row the merged state of all rows of its group before it in the order of ``digits``; rows with none before
    are left out.

    The digits are a tree: rows that agree in all but the last are totalled, the totals are prefix-summed in the same way, and
    each such block starts from its prefix.  So a task sees one block, or one row for each block.
    """
    *upper, last = digits
    rows = states.select(*group, *digits, *state_names(aggs), F.lit(False).alias("_seed"))
    if upper:
        above = prefix(merged(states, [*group, *upper], aggs), group, upper, aggs, reverse)
        rows = rows.unionByName(above.withColumn("_seed", F.lit(True)), allowMissingColumns=True)
    walk = F.col(last).desc() if reverse else F.col(last).asc()
    frame = Window.partitionBy(*group, *upper).orderBy(F.col("_seed").desc(), walk).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        *group, *digits, "_seed", (F.count(F.lit(1)).over(frame) > 0).alias("_any"),
        *[c.over(frame).alias(n) for n, c in merges(aggs)],
    ).where(~F.col("_seed") & F.col("_any")).drop("_seed", "_any")


def scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    aggs: Sequence[Agg],
    inclusive: bool = True,
    reverse: bool = False,
    split: Split | None = None,
    totals_from: DataFrame | None = None,
) -> DataFrame:
    """Add each aggregate over the rows of the group up to (``inclusive``) or strictly before the row.

    ``order`` must be unique within a group.  ``reverse`` walks it backwards.  ``split`` comes from :func:`plan_split` on keys
    that are part of ``group``; None means every group fits a task.  If ``df`` is costly to compute twice, ``totals_from``
    may hold the same rows with fewer columns.
    """
    names = state_names(aggs)
    states = df.select("*", *state_columns(aggs))
    direction = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    last = 0 if inclusive else -1

    if split is None:
        frame = Window.partitionBy(*group).orderBy(*map(direction, order)).rowsBetween(Window.unboundedPreceding, last)
        rows = states
    else:
        rows = split.assign(states)
        summed = rows if totals_from is None else split.assign(totals_from.select("*", *state_columns(aggs)))
        totals = merged(summed.where(F.col(BUCKET) > 0), [*group, BUCKET], aggs)
        blocks = [] if split.ranges <= FLAT else ["_ranges"]
        totals = totals.withColumns({b: F.floor(F.col(BUCKET) / math.isqrt(split.ranges)) for b in blocks})
        seeds = prefix(totals, group, [*blocks, BUCKET], aggs, reverse).drop(*blocks).withColumn("_seed", F.lit(True))
        rows = rows.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
        frame = (
            Window.partitionBy(*group, BUCKET)
            .orderBy(F.col("_seed").desc(), *map(direction, order))
            .rowsBetween(Window.unboundedPreceding, last)
        )

    running = rows.select(
        *[c for c in rows.columns if c not in names],
        *[c.over(frame).alias(n) for n, c in merges(aggs)],
    )
    if split is not None:
        running = running.where(~F.col("_seed"))
    return running.select(*df.columns, *final_columns(aggs))
