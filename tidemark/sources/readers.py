"""Sources.  All give DataFrames; text sources have a ``value`` column for ``tidemark.functions.parse``.  Schemas are fixed, never inferred."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parse import EDIT_JSON, parse
from tidemark.functions.times import from_millis


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A small collection, for fixtures and examples; real data comes from storage."""
    return spark.createDataFrame(list(rows), schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, numbered in ``arr``: increasing within a file, no promise across files."""
    return spark.read.text(path).withColumn("arr", F.monotonically_increasing_id())


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files as they land in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str) -> DataFrame:
    """Kafka messages as text with ``timestamp``, ``partition`` and ``offset``.  Needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting).options(**options)
    )
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket.  For development: a socket cannot be replayed, so it is not fault tolerant."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def read_edits(spark: SparkSession, path: str, streaming: bool = False, mode: str = "drop") -> DataFrame:
    """Edit events (``user``, ``byte_diff``) landed as JSON lines."""
    lines = stream_lines(spark, path) if streaming else spark.read.text(path)
    return parse(lines, EDIT_JSON, mode).rows


def replay(spark: SparkSession, rows: Iterable[Sequence], schema: str, ts_ms: str) -> DataFrame:
    """A short recorded stream: rows numbered in ``arr`` by their place in the list, with event time ``ts``."""
    numbered = [(*row, i) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, f"{schema}, arr bigint").withColumn("ts", from_millis(ts_ms))
