"""Sorts of the delta trigger are dealt out by the number of rows, so that no task's share grows with the table."""

import datetime

from pyspark.sql import functions as F

from tidemark.operators import delta

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


def test_more_rows_are_more_tasks(spark):
    rows = spark.range(600).select(
        (F.col("id") % 40).alias("k"), "id", F.timestamp_seconds(F.lit(int(START.timestamp())) + F.col("id")).alias("ts"),
        F.col("id").cast("double").alias("far"), ((F.col("id") * 37) % 101).alias("speed"))

    def top():
        return delta.delta_trigger_top(rows, ["k"], ["id"], "ts", "far", "speed", 50.0, 60_000, ["speed"])

    plain = top()
    tasks = spark.sparkContext.defaultParallelism + 3
    spark.conf.set(delta.TASK_ROWS_SETTING, str(600 // tasks))
    try:
        dealt = top()
    finally:
        spark.conf.unset(delta.TASK_ROWS_SETTING)
    assert plain.collect() and sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))
    assert "RepartitionByExpression" not in plain._jdf.queryExecution().optimizedPlan().toString()
    text = dealt._jdf.queryExecution().optimizedPlan().toString()
    counts = [int(line.rsplit(", ", 1)[1]) for line in text.splitlines() if "RepartitionByExpression" in line]
    # The rows and the two questions of each firing.
    assert max(counts) >= (600 + 2 * plain.count()) // (600 // tasks)
