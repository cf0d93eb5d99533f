"""Running aggregates, with and without hot groups, against plain Python."""

import math
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.aggregates import (
    count_rows, final_columns, first_by, greatest, joined, last_by, least, state_columns, top_row, total,
)
from tidemark.operators.countwin import count_sliding, count_tumbling
from tidemark.operators.scan import BUCKET, plan_split, prefix, scan
from tidemark.operators.windows import concat_in_order


def skewed(seed=1, n=900):
    """A third of the rows under one key, a third at one order value, null keys and values among them."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None])
        arr = 500 if rnd.random() < 0.35 else rnd.randrange(1000)
        rows.append((key, arr, i, rnd.choice([None, *range(-5, 20)])))
    return rows


SCHEMA = "key string, arr long, id long, v long"


@pytest.fixture(scope="module")
def table(spark):
    rows = skewed()
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute(rows, inclusive, reverse):
    out = {}
    state = {}
    for key, arr, i, v in sorted(rows, key=lambda r: (r[1], r[2]), reverse=reverse):
        seen = state.setdefault(key, [])
        if inclusive:
            seen.append((arr, i, v))
        vals = [x[2] for x in seen if x[2] is not None]
        out[i] = (len(seen), sum(vals) if vals else None, min(vals, default=None), max(vals, default=None))
        if not inclusive:
            seen.append((arr, i, v))
    return out


@pytest.mark.parametrize("hot_rows", [10**6, 50])
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("reverse", [True, False])
def test_scan_matches_brute_force(table, hot_rows, inclusive, reverse):
    rows, df = table
    split = plan_split(df, ["key"], ["arr", "id"], hot_rows=hot_rows, buckets=6)
    assert (split is None) == (hot_rows > 1000)
    aggs = [count_rows("n"), total("v", "s"), least("v", "lo"), greatest("v", "hi")]
    out = scan(df, ["key"], ["arr", "id"], aggs, inclusive=inclusive, reverse=reverse, split=split)
    got = {r["id"]: (r["n"], r["s"], r["lo"], r["hi"]) for r in out.collect()}
    assert got == brute(rows, inclusive, reverse)


def test_scan_without_keys_is_cut(table):
    rows, df = table
    split = plan_split(df, [], ["arr", "id"], buckets=5)
    out = scan(df, [], ["arr", "id"], [count_rows("n"), total("v", "s")], split=split)
    got = {r["id"]: (r["n"], r["s"]) for r in out.collect()}
    want = brute([("x", *r[1:]) for r in rows], True, False)
    assert got == {k: v[:2] for k, v in want.items()}


def test_ranges_are_small_even_with_one_heavy_order_value(table):
    rows, df = table
    split = plan_split(df, ["key"], ["arr", "id"], hot_rows=50, buckets=10)
    assert split.heavy and split.opened
    sizes = split.assign(df).where(F.col(BUCKET) > 0).groupBy("key", BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= len(rows) / 10 * 2
    # Range numbers grow with the order.
    order = split.assign(df).where("key = 'hot'").select("arr", "id", BUCKET).orderBy("arr", "id").collect()
    numbers = [r[BUCKET] for r in order]
    assert numbers == sorted(numbers)


def test_ties_on_two_levels(spark):
    rows = [(i % 2 and 7 or i, i % 3 and 5 or i, i) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(3)
    split = plan_split(df, [], ["a", "b", "c"], buckets=8)
    assert len(split.opened) >= 2
    assert split.assign(df).groupBy(BUCKET).count().agg(F.max("count")).first()[0] <= 100
    out = scan(df, [], ["a", "b", "c"], [count_rows("n")], split=split)
    want = {r: i + 1 for i, r in enumerate(sorted(rows))}
    assert {(r["a"], r["b"], r["c"]): r["n"] for r in out.collect()} == want


def test_order_values_beyond_double_precision(spark):
    """Neighbouring large integers share a double; the order must still be theirs."""
    rows = [(2**60 + i % 90, -i, i) for i in range(300)] + [(0, -i, i) for i in range(300, 400)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(3)
    out = scan(df, [], ["a", "b"], [count_rows("n")], split=plan_split(df, [], ["a", "b"], buckets=8))
    want = {r[2]: i + 1 for i, r in enumerate(sorted(rows))}
    assert {r["c"]: r["n"] for r in out.collect()} == want


@pytest.mark.parametrize("kind", ["double", "float", "decimal(20,2)", "decimal(38,18)", "int"])
def test_order_types(spark, kind):
    rows = [(x, i) for i, x in enumerate([0.0, -0.0, 1.5, -2.0, None, 0.0, -0.0, 7.0] * 20)]
    df = spark.createDataFrame(rows, "x double, id long").withColumn("x", F.col("x").cast(kind))
    out = scan(df, [], ["x", "id"], [count_rows("n")], split=plan_split(df, [], ["x", "id"], buckets=6))
    plain = scan(df, [], ["x", "id"], [count_rows("n")])
    assert sorted((r["id"], r["n"]) for r in out.collect()) == sorted((r["id"], r["n"]) for r in plain.collect())


def test_first_last_top(table):
    rows, df = table
    aggs = [first_by("id", ["arr", "id"], "f"), last_by("id", ["arr", "id"], "l"), top_row("v", ["arr", "id"], ["id"], "t")]
    for hot_rows in (10**6, 50):
        split = plan_split(df, ["key"], ["arr", "id"], hot_rows=hot_rows, buckets=6)
        out = scan(df, ["key"], ["arr", "id"], aggs, split=split)
        seen = {}
        want = {}
        for key, arr, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
            s = seen.setdefault(key, [])
            s.append((arr, i, v))
            best = max((x for x in s if x[2] is not None), key=lambda x: (x[2], -x[0], -x[1]), default=None)
            want[i] = (s[0][1], i, best and best[1])
        got = {r["id"]: (r["f"], r["l"], r["t"] and r["t"]["id"]) for r in out.collect()}
        assert got == want


def brute_count_windows(rows, n, slide):
    per_key = {}
    for key, arr, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        per_key.setdefault(key, []).append(i)
    out = set()
    for key, ids in per_key.items():
        if slide is None:
            for w in range(len(ids) // n):
                out.add((key, w + 1, "|".join(map(str, ids[w * n:(w + 1) * n]))))
        else:
            for w in range(1, len(ids) // slide + 1):
                out.add((key, w, "|".join(map(str, ids[max(0, w * slide - n):w * slide]))))
    return out


@pytest.mark.parametrize("hot_rows", [10**6, 50])
@pytest.mark.parametrize("n,slide", [(3, None), (3, 2), (2, 5), (7, 7), (1, 1), (5, 1)])
def test_count_windows(table, hot_rows, n, slide):
    rows, df = table
    df = df.withColumn("text", F.col("id").cast("string"))
    split = plan_split(df, ["key"], ["arr", "id"], hot_rows=hot_rows, buckets=6)
    aggs = [joined("text", ["arr", "id"], "|", "ids")]
    if slide is None:
        out = count_tumbling(df, ["key"], ["arr", "id"], n, aggs, split)
    else:
        out = count_sliding(df, ["key"], ["arr", "id"], n, slide, aggs, split)
    got = [(r["key"], r["window_no"], r["ids"]) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == brute_count_windows(rows, n, slide)


@pytest.mark.parametrize("hot_rows", [10**6, 50])
def test_concat_in_order(table, hot_rows):
    rows, df = table
    df = df.withColumn("text", F.when(F.col("v") > 0, F.col("id").cast("string")))
    split = plan_split(df, ["key"], ["arr", "id"], hot_rows=hot_rows, buckets=6)
    out = concat_in_order(df, ["key"], ["arr", "id"], "text", "|", "ids", [count_rows("n")], split)
    want = {}
    for key, arr, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        s = want.setdefault(key, [0, []])
        s[0] += 1
        if v is not None and v > 0:
            s[1].append(str(i))
    assert {r["key"]: (r["n"], r["ids"]) for r in out.collect()} == {k: (n, "|".join(x)) for k, (n, x) in want.items()}


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert plan_split(empty, ["key"], ["arr", "id"]) is None
    assert scan(empty, [], ["arr"], [count_rows()], split=plan_split(empty, [], ["arr"])).count() == 0
    one = spark.createDataFrame([("a", 1, 1, 1)], SCHEMA)
    assert scan(one, [], ["arr"], [count_rows()], split=plan_split(one, [], ["arr"])).first()["n"] == 1


def test_every_hot_key_is_cut_and_order_types_are_checked_first(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.scan import BUCKET, plan_split

    rows = spark.range(5000).select((F.col("id") % 50).alias("k"), F.col("id").alias("n"))
    split = plan_split(rows, ["k"], ["n"], hot_rows=10)
    whole = split.assign(rows).groupBy("k").agg(F.min(BUCKET).alias("low")).where("low = 0")
    assert whole.count() == 0
    for kind in ("string", "date", "timestamp_ntz", "decimal(20,2)"):
        value = F.date_add(F.lit("2020-01-01"), F.col("n").cast("int")) if kind in ("date", "timestamp_ntz") else F.col("n")
        typed = rows.withColumn("n", value.cast(kind))
        assert plan_split(typed, ["k"], ["n"], hot_rows=10).assign(typed).select("k", BUCKET).distinct().count() > 10 * 50 / 2
    with pytest.raises(TypeError):
        plan_split(rows.withColumn("n", F.array("n")), ["k"], ["n"], hot_rows=10_000)


def test_inner_separators_are_split_in_linear_time(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.parse import space_tokens

    row = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), F.lit(300_000)), F.lit("b ")).alias("t"))
    assert row.select(F.size(space_tokens("t"))).first()[0] == 300_001


BIG = 2**62


@pytest.mark.parametrize("kind,values", [
    ("long", [0, -1, 1, BIG, BIG + 1, BIG + 2047, BIG + 2048, -BIG, None, 2**63 - 1, -(2**63)]),
    ("double", [0.0, -0.0, 1e300, 1.7e308, -1.7e308, 5e-324, math.inf, -math.inf, math.nan, None, 1.0, 1.0000000000000002]),
    ("string", ["", None, "a", "a\x00", "ab", "2024-01-01 00:00:00", "2024-01-01 00:00:01", "\U0001f600", "é", "z" * 50, "z" * 49 + "y"]),
    ("decimal(38,18)", [Decimal(x) for x in ("0", "-0.5", "0.5", "1e-18", "-1e-18", "12345678901234567890.123456789012345678",
                                             "12345678901234567890.123456789012345679", "-99999999999999999999.999999999999999999")]),
    ("decimal(38,0)", [Decimal(x) for x in (0, -1, 10**37, 10**37 + 1, 10**30, 10**30 - 1, 10**15, 10**15 - 1)]),
    ("boolean", [True, False, None]), ("date", ["2024-02-29", "1969-12-31", None]),
    ("timestamp", ["2024-02-29 00:00:00", "2024-02-29 00:00:00.000001", "1960-01-01 00:00:00", None]),
])
def test_ranges_follow_the_order_of_any_type(spark, kind, values):
    """Each value often, so that every level of cells and the next column take part."""
    rows = [(v, i) for i, v in enumerate(values * 40)]
    text = kind in ("date", "timestamp")
    df = spark.createDataFrame(rows, f"x {'string' if text else kind}, id long").withColumn("x", F.col("x").cast(kind))
    split = plan_split(df, [], ["x", "id"], buckets=20)
    got = split.assign(df).orderBy("x", "id").select(BUCKET).collect()
    numbers = [r[0] for r in got]
    assert numbers == sorted(numbers) and numbers[0] > 0
    share = math.ceil(len(rows) / 20)
    assert max(numbers.count(n) for n in set(numbers)) < 2 * share and len(set(numbers)) <= 2 * 20


def test_rows_that_were_not_planned_find_their_place(spark):
    planned = spark.createDataFrame([(t, i) for i in range(300) for t in (10, 20 + i % 3)], "t long, id long")
    split = plan_split(planned, [], ["t", "id"], buckets=12)
    assert split.heavy
    asked = spark.createDataFrame([(t, i) for t in range(-5, 40) for i in (-7, 0, 150, 299, 10**9)], "t long, id long")
    both = split.assign(planned.unionByName(asked)).orderBy("t", "id").select(BUCKET).collect()
    assert [r[0] for r in both] == sorted(r[0] for r in both)
    first = split.by_first_column().assign(planned).groupBy("t").agg(F.countDistinct(BUCKET).alias("n"))
    assert {r["n"] for r in first.collect()} == {1}


def test_own_cuts_for_each_frequent_value(spark):
    """Two frequent values with far-apart second columns: shared borders would leave most ranges of each empty."""
    rows = [(1, i) for i in range(500)] + [(2, 10**12 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long")
    sizes = plan_split(df, [], ["a", "b"], buckets=20).assign(df).groupBy(BUCKET).count().collect()
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) < 100


def test_four_levels_of_many_ranges_number_without_overflow(spark):
    """Range numbers count shares of rows; with 60,000 ranges on each of four columns a product would not fit 64 bits."""
    df = spark.range(120_000).select(*[F.when(F.col("id") % (j + 2) > 0, 5 + j).otherwise(F.col("id") * 10**9).alias(c)
                                       for j, c in enumerate("abc")], F.col("id").alias("d"))
    split = plan_split(df, [], ["a", "b", "c", "d"], buckets=60_000)
    got = split.assign(df).groupBy(BUCKET).count().agg(F.max("count"), F.max(BUCKET), F.count("*")).first()
    assert got[0] < 8 and got[1] <= 60_001 and got[2] > 20_000
    out = scan(df, [], ["a", "b", "c", "d"], [count_rows("n")], split=split)
    wrong = out.withColumn("want", F.row_number().over(Window.orderBy("a", "b", "c", "d"))).where("n <> want")
    assert wrong.count() == 0


@pytest.mark.parametrize("reverse", [True, False])
def test_prefix_as_a_tree(spark, reverse):
    rows = [(g, d // 100, d // 10, d) for g in "ab" for d in range(0, 1000, 7)]
    df = spark.createDataFrame(rows, "g string, d0 long, d1 long, d2 long").withColumn("v", F.col("d2"))
    aggs = [total("v", "s"), first_by("v", ["v"], "f"), last_by("v", ["v"], "l")]
    found = prefix(df.select("*", *state_columns(aggs)), ["g"], ["d0", "d1", "d2"], aggs, reverse)
    got = {(r["g"], r["d2"]): (r["s"], r["f"], r["l"]) for r in found.select("g", "d2", *final_columns(aggs)).collect()}
    want = {}
    for g in "ab":
        for d in range(0, 1000, 7):
            seen = [x for x in range(0, 1000, 7) if (x > d if reverse else x < d)]
            if seen:
                want[g, d] = (sum(seen), min(seen), max(seen))
    assert got == want


def test_no_task_sees_all_ranges(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("v"))
    out = scan(df, [], ["id"], [total("v", "s")], split=plan_split(df, [], ["id"], buckets=5_000))
    text = out._jdf.queryExecution().executedPlan().toString()
    # What meets in one task are the totals of blocks, about a hundred.
    alone = re.findall(r"Exchange SinglePartition.*\n(.*)\n", text)
    assert alone and all("HashAggregate(keys=[_ranges" in x for x in alone)
    assert out.agg(F.max("s")).first()[0] == sum(i % 7 for i in range(20_000))
